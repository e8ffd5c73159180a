"""Jobs and queries: silver cleaning, the gold star schema, recommendations,
dashboard analytics and the full pipeline."""
