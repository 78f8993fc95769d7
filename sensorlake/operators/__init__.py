"""DataFrame operators: staging, marts, data-quality checks, anchor date,
reports, features, quantile boosting and backtests."""
