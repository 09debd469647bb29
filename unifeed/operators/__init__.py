"""unifeed.operators."""
