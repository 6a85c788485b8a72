"""The star: staging, marts, cards, lookups, rewrites and checks over named relations."""
