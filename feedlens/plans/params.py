"""Parameters of the registered queries (the clock and sizes of the test plan)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---- fixed values: these must equal the analysed pipelines' for equal results ----
SPLIT_SALT = "exp_mess_1"  # experiment split: md5("<user_id>-exp_mess_1") mod 5
SPLIT_GROUPS = 5
SMOOTHING_ALPHA = 5.0  # smoothed CTR: (likes + 5 * group CTR) / (views + 5)
ALERT_IQR_WIDTH = 5.0  # alert band: q75 + 5 * iqr, q25 - 5 * iqr
ALERT_WINDOW = 5  # previous 5 buckets for the quartiles; 5-row centred smoothing
ALERT_BUCKET_MINUTES = 15
REPORT_WINDOW_DAYS = 8  # today - 8 .. today - 1
BUCKET_QUANTILE = 0.9  # quantile of user CTR per bucket
P_ALPHA = 0.05
# sizes used by the analysed notebooks:
# 10,000 A/A simulations of 500 users per group, 2,000 bootstrap replicates, 50 buckets
REFERENCE_SIZES = {"n_sims": 10_000, "k": 500, "n_bootstrap": 2_000, "n_buckets": 50}


@dataclass(frozen=True)
class Params:
    as_of: dt.date = dt.date(2024, 1, 31)  # "today": yesterday = 2024-01-30
    now: dt.datetime = dt.datetime(2024, 1, 31, 0, 0, 0)  # alert clock
    report_days: int = REPORT_WINDOW_DAYS
    exp_first: dt.date = dt.date(2024, 1, 8)
    exp_last: dt.date = dt.date(2024, 1, 14)
    split_salt: str = SPLIT_SALT
    n_groups: int = SPLIT_GROUPS
    ab_groups: tuple[int, int] = (1, 2)
    aa_groups: tuple[int, int] = (2, 3)
    lin_pairs: tuple[tuple[int, int], ...] = ((0, 3), (1, 2))
    alpha_smooth: float = SMOOTHING_ALPHA
    # the analysed notebooks' sizes; where a group has fewer than 2 k users, half of the smaller one is drawn
    n_sims: int = 10_000
    k: int = 500
    aa_salt: str = "aa"
    n_bootstrap: int = 2_000
    boot_salt: str = "boot"
    n_buckets: int = 50
    bucket_salt: str = "bucket"
    bucket_q: float = BUCKET_QUANTILE
    hist_bins: str = "auto"  # seaborn histplot default
    pvalue_bins: int = 10  # pandas Series.hist default
    alert_a: float = ALERT_IQR_WIDTH
    alert_n: int = ALERT_WINDOW
    p_alpha: float = P_ALPHA

    @property
    def yesterday(self) -> dt.date:
        return self.as_of - dt.timedelta(days=1)

    @property
    def window(self) -> tuple[dt.date, dt.date]:
        return self.as_of - dt.timedelta(days=self.report_days), self.yesterday


DEFAULT = Params()

# Digits kept when results are compared with the SQL oracle.
DIGITS = 6
