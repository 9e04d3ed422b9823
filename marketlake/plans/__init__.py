"""Set-based plans: what is missing, the market measures, and the dataset runs."""
