"""Reading warehouse tables, writing exports, and keeping models and intermediate tables."""
