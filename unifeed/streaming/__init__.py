"""unifeed.streaming."""
