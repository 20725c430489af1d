"""Operators: DataFrame in, DataFrame out.

activity   - per-user daily rollups, the faithful and clean message joins, the metric cube
audience   - DAU series, daily report row, week-over-week changes
retention  - weekly new / retained / lost users (full history or incremental store)
alerts     - 15-minute series, IQR bands, latest-bucket alerts, backtest
experiments/ - A/B metrics, split, two-sample tests, resampling, distributions
"""
