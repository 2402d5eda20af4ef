"""Customer clusters, churn, returns, seasonality, correlation and baskets."""
