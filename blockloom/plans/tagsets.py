"""Ordered tag sets over summaries of H blocks, E runs and F addresses, as rule data for operators/rules.py."""

from __future__ import annotations

#: Fixed: names of the carriers and of cloud and cable providers in the operator column.
CARRIERS = {"telecom": "中国电信", "unicom": "中国联通", "cmcc": "中国移动"}
CABLE = "广电网"
CLOUDS = ["阿里云", "腾讯云", "华为云", "百度云", "亚马逊", "微软", "京东云", "天翼云", "UCloud", "金山云"]
CABLES = [
    "广东广电", "歌华有线", "天威视讯", "东方有线", "江苏广电", "广州广电", "福建广电", "河北广电", "吉视传媒股份有限公司", "山东广电", "内蒙古广电", "湖南有线", "重庆广电", "厦门广电", "陕西广电", "贵州广电",
    "宁夏广电", "天津广电", "河南广电", "湖北楚天广电", "北方联合广电", "同煤通信", "广电网",
]

Tags = list[tuple[str, dict]]


def at(field: str, op: str, value) -> dict:
    return {"field": field, "op": op, "value": value}


def every(*rules: dict) -> dict:
    return {"all": list(rules)}


def h_tags(carriers: dict[str, str] = CARRIERS, clouds: list[str] = CLOUDS) -> Tags:
    """Twelve tags of H blocks; the first that holds counts."""
    own = lambda c: at("top_operator", "=", carriers[c])
    # a carrier's mobile exits: least DAA/DNA, least devices an address
    least = {"cmcc": (8, 20), "unicom": (8, 20), "telecom": (3, 5)}
    fixed = [at("wifi_device_ratio", ">=", 0.9), at("daa_dna_ratio", ">=", 6), at("avg_apps_per_device", ">=", 0.1)]
    mobile = [(f"mobile_{c}", every(own(c), at("mobile_device_ratio", ">=", 0.85), at("daa_dna_ratio", ">=", daa), at("avg_apps_per_ip", ">=", 5), at("avg_devices_per_ip", ">=", devices))) for c, (daa, devices) in least.items()]
    return [
        *mobile,
        ("network_mixed", every(at("mobile_device_ratio", ">=", 0.1), at("daa_dna_ratio", ">=", 5), at("avg_apps_per_ip", ">=", 5))),
        ("cloud_proxy", at("top_operator", "in", clouds)),
        ("android_id_anomaly", {"any": [at("android_device_ratio", ">=", 1.2), at("android_oaid_ratio", ">=", 1.5)]}),
        ("app_fraud", {"any": [at("avg_apps_per_ip", "<=", 3), at("report_oaid_ratio", ">", 20)]}),
        ("device_fraud", at("daa_dna_ratio", "<", 3)),
        *[(f"wifi_{c}", every(own(c), *fixed)) for c in ("telecom", "cmcc", "unicom")],
        ("wifi_other", every(*fixed)),
    ]


def _first(clouds: list[str]) -> Tags:
    return [("cloud_service", at("top_operator", "in", clouds)), ("root_anomaly", at("root_report_ratio", ">=", 0.2))]


def e_tags(carriers: dict[str, str] = CARRIERS, clouds: list[str] = CLOUDS, cable: str = CABLE, cables: list[str] = CABLES) -> Tags:
    """Fourteen tags of E runs."""
    named = {**carriers, "guangdian": cable}
    order = ["telecom", "unicom", "cmcc"]
    night, wifi = at("late_night_report_ratio", ">=", 0.05), at("wifi_device_ratio", ">=", 0.9)
    office = [at("workday_report_ratio", ">=", 0.65), at("workday_report_ratio", "<=", 0.8)]
    return [
        *_first(clouds),
        *[(f"mobile_{c}", every(at("top_operator", "=", named[c]), at("mobile_device_ratio", ">=", 0.85), at("daa_dna_ratio", ">=", 3))) for c in (*order, "guangdian")],
        *[(f"scattered_mobile_{c}", every(at("top_operator", "=", named[c]), at("mobile_device_ratio", ">=", 0.3))) for c in order],
        *[(f"broadband_{c}", every(at("top_operator", "=", named[c]), *office, night, wifi)) for c in order],
        ("broadband_guangdian", every(wifi, night, at("top_operator", "in", cables))),
        ("broadband_other", every(wifi, night, at("mobile_device_ratio", "<", 0.3))),
    ]


def f_tags(clouds: list[str] = CLOUDS) -> Tags:
    """Six tags of F addresses."""
    return [
        *_first(clouds),
        ("mobile_exit", every(at("mobile_device_ratio", ">=", 0.85), at("daa_dna_ratio", ">=", 3))),
        ("enterprise_line", every(at("workday_report_ratio", ">=", 0.85), at("late_night_report_ratio", "<", 0.03), at("wifi_device_ratio", ">=", 0.8))),
        ("scattered_mobile", at("mobile_device_ratio", ">=", 0.3)),
        ("residential_broadband", every(at("wifi_device_ratio", ">=", 0.9), at("late_night_report_ratio", ">=", 0.05))),
    ]
