"""The layers as Structured Streaming jobs: arrivals, upserts, refreshes."""
