"""Churn project: the (user, bin) table and its cohort questions."""

from __future__ import annotations

from tidemark.operators.bins import user_time_bins
from tidemark.plans.registry import register
from tidemark.sources import testdata as td

N_DAYS = 7


def churn_features(spark, sf_dir, n_days: int = N_DAYS, approx_distinct: bool = False):
    ev = td.music_events(spark, sf_dir)
    return user_time_bins(ev, n_days, pages=td.MUSIC_PAGES, churn_page=td.CHURN_PAGE,
                          downgrade_page=td.DOWNGRADE_PAGE, upgrade_page=td.UPGRADE_PAGE,
                          approx_distinct=approx_distinct)


_page_counts = ",\n".join(
    f"    CAST(count(CASE WHEN page = '{p}' THEN 1 END) AS INTEGER) AS {p}" for p in td.MUSIC_PAGES)

# The oracle keeps the reference's own formulation: an aggregate, an equi
# self-join on bin = bin' - 1 and a theta self-join on bin > bin'.
CHURN_SQL = f"""
WITH {td.MUSIC_SQL},
binned AS (
  SELECT *, CAST((ts - registration) // {N_DAYS * 86400000} AS INTEGER) AS UserTimeBin,
         (ts - registration) / 86400000.0 AS days
  FROM music WHERE userId IS NOT NULL AND userId <> ''),
fe AS (
  SELECT userId AS UserId, UserTimeBin,
    CAST(max(CASE WHEN gender = 'M' THEN 1 ELSE 0 END) AS INTEGER) AS Gender,
    CAST(max(CASE WHEN level = 'paid' THEN 1 ELSE 0 END) AS INTEGER) AS PaidInTimeBin,
    CAST(max(CASE WHEN level = 'free' THEN 1 ELSE 0 END) AS INTEGER) AS FreeInTimeBin,
    CAST(max(CASE WHEN page = '{td.CHURN_PAGE}' THEN 1 ELSE 0 END) AS INTEGER) AS ChurnedInTimeBin,
    CAST(max(CASE WHEN page = '{td.DOWNGRADE_PAGE}' THEN 1 ELSE 0 END) AS INTEGER) AS DowngradedInTimeBin,
    CAST(max(CASE WHEN page = '{td.UPGRADE_PAGE}' THEN 1 ELSE 0 END) AS INTEGER) AS UpgradedInTimeBin,
    CAST(trunc(min(days)) AS INTEGER) AS DaysRegisteredAtTimeBin,
{_page_counts},
    CAST(count(DISTINCT sessionId) AS INTEGER) AS SessionsInTimeBin,
    CAST(count(DISTINCT artist) AS INTEGER) AS ArtistsInTimeBin,
    CAST(count(DISTINCT song) AS INTEGER) AS DistinctSongsInTimeBin
  FROM binned GROUP BY 1, 2),
nxt AS (
  SELECT DISTINCT a.UserId, a.UserTimeBin FROM fe a JOIN fe c
    ON a.UserId = c.UserId AND a.UserTimeBin = c.UserTimeBin - 1 WHERE c.ChurnedInTimeBin = 1),
prev AS (
  SELECT DISTINCT a.UserId, a.UserTimeBin FROM fe a JOIN fe d
    ON a.UserId = d.UserId AND a.UserTimeBin > d.UserTimeBin WHERE d.DowngradedInTimeBin = 1)
SELECT fe.*,
  CAST(CASE WHEN nxt.UserId IS NULL THEN 0 ELSE 1 END AS INTEGER) AS WillChurnInNextBin,
  CAST(CASE WHEN prev.UserId IS NULL THEN 0 ELSE 1 END AS INTEGER) AS PreviouslyDowngraded,
  CAST(CASE WHEN fe.ChurnedInTimeBin = 1 OR nxt.UserId IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS WillChurnSoon
FROM fe LEFT JOIN nxt USING (UserId, UserTimeBin) LEFT JOIN prev USING (UserId, UserTimeBin)
"""


@register("churn_user_bins", CHURN_SQL)
def q_churn_user_bins(spark, sf_dir):
    """F01 (A01-A04, J05, J06, F02, X12, X13, P01, P06): the labelled table."""
    return churn_features(spark, sf_dir)
