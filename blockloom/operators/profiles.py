"""Profiles of groups of members, the anomaly score over them, ids, and checks with severities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.operators.segments import ratio

SUMMED = ["devices", "mobile", "wifi", "reports", "workday", "late_night", "apps", "manufacturers", "daa", "dna", "oaids", "android_ids", "abnormal_net"]
#: name: (sum above, sum or count below)
RATIOS = {
    "mobile_device_ratio": ("mobile", "devices"), "wifi_device_ratio": ("wifi", "devices"), "daa_dna_ratio": ("daa", "dna"), "android_device_ratio": ("android_ids", "devices"),
    "android_oaid_ratio": ("android_ids", "oaids"), "report_oaid_ratio": ("reports", "oaids"), "workday_report_ratio": ("workday", "reports"), "late_night_report_ratio": ("late_night", "reports"),
    "root_report_ratio": ("abnormal_net", "reports"), "avg_apps_per_device": ("apps", "devices"), "avg_apps_per_ip": ("apps", "ip_count"), "avg_devices_per_ip": ("devices", "ip_count"),
    "avg_manufacturers_per_ip": ("manufacturers", "ip_count"), "avg_reports_per_ip": ("reports", "ip_count"),
}


def profile(members: DataFrame, key: str) -> DataFrame:
    """Per group: addresses, sums over valid ones, the operator most seen (ties: first in name), and ratios, null over 0."""
    sums = [F.coalesce(F.sum(F.when(F.col("is_valid"), F.col(m))), F.lit(0)).alias(m) for m in SUMMED]
    # one aggregation by group and operator, then one by group: the second sees a row an operator
    by = members.groupBy(key, "operator").agg(F.count(F.lit(1)).alias("c"), *sums)
    named = F.col("operator").isNotNull() & (F.col("operator") != "")
    top = F.min(F.when(named, F.struct((-F.col("c")).alias("neg"), "operator"))).alias("top")
    out = by.groupBy(key).agg(F.sum("c").alias("ip_count"), *[F.sum(m).alias(m) for m in SUMMED], top)
    out = out.withColumn("top_operator", F.col("top.operator")).drop("top")
    return out.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in RATIOS.items()})


#: Fixed: least values by devices an address (upper bound of the band, least value), for apps, models as a share, and makers.
APP_FLOORS = [(10, 5), (30, 10), (100, 15), (300, 30), (1000, 80)]
MODEL_SHARES = [(30, 0.5), (100, 0.6), (1000, 0.65)]
MAKER_FLOORS = [(10, 3), (30, 4), (100, 7), (300, 10), (5000, 18)]


def _banded(by: Column, bands: list[tuple[int, float]], beyond: Column) -> Column:
    out = F.when(by <= bands[0][0], bands[0][1])
    for bound, value in bands[1:]:
        out = out.when(by <= bound, value)
    return out.otherwise(beyond)


def anomaly_score(profiles: DataFrame, clouds: list[str], models: str = "avg_apps_per_ip") -> DataFrame:
    """profiles with anomaly_score (0 to 5, null where exempt) and anomaly (exempt, normal, suspicious, abnormal).

    One point for each of five measures below what groups of that density have: apps, models, makers and reports an
    address, and DAA/DNA. Groups of one address, of three at most with five devices or fewer an address, of a cloud
    operator, or of fewer than five devices an address are exempt. A null measure gives no point.
    """
    d, c = F.col("avg_devices_per_ip"), F.col
    mobile, wifi = c("mobile_device_ratio") >= 0.5, c("wifi_device_ratio") >= 0.5
    flags = [
        F.when(d > 1000, c("avg_apps_per_device") < 0.05).otherwise(c("avg_apps_per_ip") < _banded(d, APP_FLOORS, F.lit(None))),
        c(models) < F.when(d <= 10, 5.0).otherwise(d * _banded(d, MODEL_SHARES, F.lit(0.3))),
        c("avg_manufacturers_per_ip") < _banded(d, MAKER_FLOORS, F.lit(None)),
        c("daa_dna_ratio") < F.when(mobile, 7).when(wifi, 9).otherwise(5),
        c("avg_reports_per_ip") < d * F.when(wifi & ~F.coalesce(mobile, F.lit(False)), 5).otherwise(3),
    ]
    exempt = (c("ip_count") == 1) | ((c("ip_count") <= 3) & (d <= 5)) | c("top_operator").isin(clouds) | (F.coalesce(d, F.lit(0.0)) < 5)
    score = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
    out = profiles.withColumn("anomaly_score", F.when(~F.coalesce(exempt, F.lit(False)), score))
    s = F.col("anomaly_score")
    return out.withColumn("anomaly", F.when(s.isNull(), "exempt").when(s <= 1, "normal").when(s == 2, "suspicious").otherwise("abnormal"))


def padded(x: Column, width: int) -> Column:
    """x as text with zeros in front to `width` characters; longer text stays whole."""
    t = x.cast("string")
    return F.lpad(t, F.greatest(F.length(t), F.lit(width)), F.lit("0"))


def shares_equal(df: DataFrame, stored: Column, a: str, b: str, places: int = 2) -> DataFrame:
    """Rows, how many have stored = round(a / b), and the greatest difference."""
    made = F.round(ratio(F.col(a), F.col(b)), places)
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(stored == made).alias("equal"), F.round(F.max(F.abs(stored - made)), 6).alias("max_difference"))


def report(checks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(name, severity, failures, passed) from (name, severity, rows that fail)."""
    out = None
    for name, severity, failing in checks:
        one = failing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("name"), F.lit(severity).alias("severity"), "failures")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("passed", F.col("failures") == 0)


def enforce(checks: DataFrame) -> list[str]:
    """Raises if a STOP check failed; returns the names of failed WARN checks. A row a check comes to the driver."""
    failed = [(r["name"], r["severity"]) for r in checks.where("not passed").select("name", "severity").collect()]
    if stop := sorted(n for n, s in failed if s == "STOP"):
        raise ValueError(f"checks failed: {', '.join(stop)}")
    return sorted(n for n, _ in failed)
