"""The wide source: 63 columns under their source names, read into typed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed: field, source column, type (L long, D double, S string, I int), in the source's order.
FIELDS = [
    ("ip_long", "ip_long", "L"), ("ip_address", "ip_address", "S"), ("country", "IP归属国家", "S"), ("operator", "IP归属运营商", "S"), ("reports_pre", "过滤前上报次数", "L"), ("reports", "上报次数", "L"),
    ("devices_pre", "过滤前设备数量", "L"), ("devices", "设备数量", "L"), ("apps", "应用数量", "L"), ("active_days", "活跃天数", "L"), ("android_ids", "安卓ID数量", "L"), ("oaids", "OAID数量", "L"),
    ("google_ids", "谷歌ID数量", "L"), ("boot_ids", "启动ID数量", "L"), ("models", "型号数量", "L"), ("manufacturers", "制造商数量", "L"), ("late_night_reports", "深夜上报次数", "L"), ("worktime_reports", "工作时上报次数", "L"),
    ("workday_reports", "工作日上报次数", "L"), ("weekend_reports", "周末上报次数", "L"), ("ethernet_reports", "以太网接口上报次数", "L"), ("proxy_reports", "代理上报次数", "L"), ("root_reports", "Root设备上报次数", "L"), ("adb_reports", "ADB调试上报次数", "L"),
    ("charging_reports", "充电状态上报次数", "L"), ("max_single_device_reports", "单设备最大上报次数", "L"), ("daa_reports", "DAA业务上报次数", "L"), ("dna_reports", "DNA业务上报次数", "L"), ("wifi_comparable_reports", "WiFi可比上报次数", "L"),
    ("ssids", "SSID去重数", "L"), ("bssids", "BSSID去重数", "L"), ("gateway_reports", "网关存在上报次数", "L"), ("avg_reports_per_device", "平均每设备上报次数", "D"), ("weekly_active_ratio", "周活跃天数比例", "D"), ("late_night_ratio", "深夜活动比例", "D"),
    ("workday_weekend_ratio", "工作日周末平均比例", "D"), ("avg_reboots_per_device", "平均每设备重启次数", "D"), ("avg_apps_per_device", "平均每设备应用数", "D"), ("daa_dna_ratio", "DAA DNA业务比例", "D"), ("reported_app_ratio", "上报应用比例", "D"), ("low_api_device_ratio", "低安卓API设备比例", "D"),
    ("wifi_devices", "WiFi设备数量", "L"), ("wifi_device_ratio", "WiFi设备比例", "D"), ("mobile_devices", "移动网络设备数量", "L"), ("mobile_device_ratio", "移动网络设备比例", "D"), ("vpn_devices", "VPN设备数量", "L"), ("vpn_device_ratio", "VPN设备比例", "D"),
    ("empty_net_devices", "空网络状态设备数量", "L"), ("empty_net_device_ratio", "空网络状态设备比例", "D"), ("abnormal_net_devices", "异常网络设备数量", "L"), ("abnormal_net_device_ratio", "异常网络设备比例", "D"), ("wired_devices", "有线网络设备数量", "L"), ("wired_device_ratio", "有线网络设备比例", "D"),
    ("sim_unavailable_ratio", "SIM不可用比例", "D"), ("zero_total_traffic_ratio", "无效总流量设备比例", "D"), ("zero_mobile_traffic_ratio", "零移动流量设备比例", "D"), ("maker_risk_state", "制造商分布风险状态", "I"), ("sdk_anomaly_score", "SDK版本分布异常分数", "S"),
    ("start_date", "开始日期", "S"), ("end_date", "结束日期", "S"), ("created_text", "创建时间", "S"), ("active_date_list", "活跃日期列表", "S"), ("stability", "IP稳定性", "S"),
]
TYPES = {"L": "bigint", "D": "double", "S": "string", "I": "int"}
#: Fields that a run's members have under a shorter name.
SHORTER = {"ip_long": "ip", "mobile_devices": "mobile", "wifi_devices": "wifi", "vpn_devices": "vpn", "wired_devices": "wired", "abnormal_net_devices": "abnormal_net", "empty_net_devices": "empty_net", "worktime_reports": "worktime", "workday_reports": "workday", "weekend_reports": "weekend", "late_night_reports": "late_night"}


def typed(df: DataFrame) -> DataFrame:
    """The fields with their types, and `rejected`: names of those whose value isn't one of the type (null there).

    Columns that aren't of the source are left out; one that is missing is an error. Null values aren't rejected.
    """
    if missing := [source for _, source, _ in FIELDS if source not in df.columns]:
        raise ValueError(f"the source lacks {missing}")
    value = {name: F.col(f"`{source}`").try_cast(TYPES[kind]) for name, source, kind in FIELDS}
    bad = [F.when(F.col(f"`{source}`").isNotNull() & value[name].isNull(), F.lit(name)) for name, source, _ in FIELDS]
    return df.select(*[c.alias(name) for name, c in value.items()], F.array_compact(F.array(*bad)).alias("rejected"))


def kept(rows: DataFrame) -> DataFrame:
    """Typed rows that have a key."""
    return rows.where("ip_long is not null")


def rejects(rows: DataFrame) -> DataFrame:
    """(field, n): values that were refused, and under `row` the rows without a key; fields without any aren't listed."""
    names = F.concat("rejected", F.when(F.col("ip_long").isNull(), F.array(F.lit("row"))).otherwise(F.array().cast("array<string>")))
    return rows.select(F.explode(names).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def as_members(rows: DataFrame) -> DataFrame:
    """Kept rows with the names that a run's members have, all fields included; null measures of blocks count as 0."""
    named = kept(rows).drop("rejected").withColumnsRenamed(SHORTER)
    return named.fillna(0, [c for c in [*SHORTER.values(), "reports", "devices"] if c != "ip"])
