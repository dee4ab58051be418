"""Reports, checks, features, models and plans over the warehouse tables."""
