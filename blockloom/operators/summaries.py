"""Wide summaries of groups of members, generated from lists of measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed: sums over valid members, by the member's field.
SUMS = {
    "total_reports": "reports", "total_reports_pre_filter": "reports_pre", "daa_reports": "daa_reports", "dna_reports": "dna_reports", "worktime_reports": "worktime", "workday_reports": "workday", "weekend_reports": "weekend", "late_night_reports": "late_night",
    "total_devices": "devices", "total_devices_pre_filter": "devices_pre", "wifi_devices": "wifi", "mobile_devices": "mobile", "vpn_devices": "vpn", "wired_devices": "wired", "abnormal_net_devices": "abnormal_net", "empty_net_devices": "empty_net", "total_apps": "apps",
    "android_id_count": "android_ids", "oaid_count": "oaids", "google_id_count": "google_ids", "boot_id_count": "boot_ids", "model_count": "models", "manufacturer_count": "manufacturers", "ssid_count": "ssids", "bssid_count": "bssids",
    "gateway_reports": "gateway_reports", "ethernet_reports": "ethernet_reports", "wifi_comparable_reports": "wifi_comparable_reports", "proxy_reports": "proxy_reports", "root_reports": "root_reports", "adb_reports": "adb_reports", "charging_reports": "charging_reports",
}
#: Fixed: (name, above, below, decimals, factor, upper bound, value over 0). Shares that blocks and runs have alike, then those of each.
BOTH = [
    ("avg_reports_per_ip", "total_reports", "ip_count", 2, 1, None, 0), ("avg_devices_per_ip", "total_devices", "ip_count", 2, 1, None, 0), ("avg_active_days", "active_days_sum", "active_days_count", 2, 1, None, None),
    ("wifi_device_ratio", "wifi_devices", "total_devices", 4, 1, None, 0), ("mobile_device_ratio", "mobile_devices", "total_devices", 4, 1, None, 0), ("vpn_device_ratio", "vpn_devices", "total_devices", 4, 1, None, 0),
    ("workday_report_ratio", "workday_reports", "total_reports", 4, 1, None, 0), ("late_night_report_ratio", "late_night_reports", "total_reports", 4, 1, None, 0), ("daa_dna_ratio", "daa_reports", "dna_reports", 2, 1, None, None),
    ("unstable_ip_ratio", "unstable_ip_count", "ip_count", 4, 1, None, 0), ("abnormal_ip_ratio", "abnormal_ip_count", "total_ip_count", 4, 1, None, 0),
    ("avg_manufacturer_per_ip", "manufacturer_count", "ip_count", 2, 1, None, 0), ("avg_model_per_ip", "model_count", "ip_count", 2, 1, None, 0), ("avg_apps_per_ip", "total_apps", "ip_count", 2, 1, None, 0),
]
BLOCK = [
    ("android_device_ratio", "android_id_count", "total_devices", 4, 1, 99.9999, None), ("android_oaid_ratio", "oaid_count", "total_devices", 4, 1, 99.9999, None), ("report_oaid_ratio", "oaid_count", "total_reports", 4, 100, 99.9999, None),
    ("oaid_device_ratio", "oaid_count", "total_devices", 4, 1, 99.9999, None), ("avg_apps_per_device", "total_apps", "total_devices", 4, 1, None, None),
]
RUN = [
    ("android_device_ratio", "android_id_count", "total_devices", 4, 1, None, 0), ("android_oaid_ratio", "oaid_count", "android_id_count", 4, 1, None, 0), ("report_oaid_ratio", "oaid_count", "total_reports", 4, 1, None, 0),
    ("oaid_device_ratio", "oaid_count", "total_devices", 4, 1, None, 0), ("avg_apps_per_device", "total_apps", "total_devices", 2, 1, None, 0), ("weekend_report_ratio", "weekend_reports", "total_reports", 4, 1, None, 0), ("root_report_ratio", "root_reports", "total_reports", 4, 1, None, 0),
]


def share(above: str, below: str, places: int, factor: int = 1, most: float | None = None, empty: float | None = 0) -> Column:
    """above / below rounded half up, by whole numbers, so it is the decimal result; `empty` where below is 0."""
    unit = 10**places
    exact = F.expr(f"cast((2 * cast({above} as decimal(20,0)) * {factor * unit} + {below}) div (2 * nullif({below}, 0)) as double) / {unit}")
    bound = exact if most is None else F.when(exact > most, most).otherwise(exact)
    return F.when(F.col(below) > 0, bound).otherwise(F.lit(empty).cast("double"))


def wide(members: DataFrame, key: str, ratios: list[tuple], unstable: str = "unstable") -> DataFrame:
    """One row a group that has a valid member: counts, sums over valid members, greatest single reports, operators, ratios.

    Two aggregations, by group and operator and then by group, so that the second sees a row an operator. The operator
    most seen is the first by name among equals; null and empty ones don't count.
    """
    valid = F.col("is_valid")
    own = lambda c: F.when(valid, c)
    sums = [F.sum(own(F.col(c))).alias(name) for name, c in SUMS.items()]
    by = members.groupBy(key, "operator").agg(
        F.count_if(valid).alias("c"), F.count(F.lit(1)).alias("all"), *sums, F.max(own(F.col("max_single_device_reports"))).alias("max_single_device_reports"),
        F.sum(own(F.col("active_days"))).alias("active_days_sum"), F.count(own(F.col("active_days"))).alias("active_days_count"), F.count_if(valid & (F.col("stability") == unstable)).alias("unstable_ip_count"),
    )
    named = (F.col("c") > 0) & F.col("operator").isNotNull() & (F.col("operator") != "")
    out = by.groupBy(key).agg(
        F.sum("c").alias("ip_count"), F.sum("all").alias("total_ip_count"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in SUMS], F.max("max_single_device_reports").alias("max_single_device_reports"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("active_days_sum", "active_days_count", "unstable_ip_count")],
        F.min(F.when(named, F.struct((-F.col("c")).alias("neg"), "operator"))).alias("top"), F.count_if(named).alias("distinct_operators"),
    ).where("ip_count > 0")
    out = out.withColumns({"top_operator": F.col("top.operator"), "abnormal_ip_count": F.col("total_ip_count") - F.col("ip_count")})
    return out.withColumns({name: share(*rest) for name, *rest in ratios}).drop("top", "active_days_sum", "active_days_count", "total_ip_count")
