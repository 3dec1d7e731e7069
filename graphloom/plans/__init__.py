"""Multi-step jobs: graph projection and graph algorithms."""
