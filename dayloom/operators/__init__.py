"""DataFrame operators: panels, features, exploration, forecasts, backtests, monitoring."""
