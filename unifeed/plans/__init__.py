"""unifeed.plans."""
