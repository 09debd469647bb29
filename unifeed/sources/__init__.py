"""unifeed.sources."""
