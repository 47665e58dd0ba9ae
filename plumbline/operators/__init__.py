"""DataFrame operators: rules, profiling, cleaning, imputation, series, statistics, models."""
