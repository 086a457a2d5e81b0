"""Reading both sides, listing extract runs, storing intermediate and final results."""
