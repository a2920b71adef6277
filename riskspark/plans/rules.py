"""Table-driven rules on table and variable names: category, platform, join keys."""

from __future__ import annotations

from dataclasses import dataclass

BEHAVIOUR, EXTERNAL, CREDIT, MODEL, UNKNOWN = "行为变量", "外部数据", "征信变量", "模型分", "未知"

#: Fixed values: (category, prefixes of lower-cased table names, exact names), the first that fits holds.
CATEGORIES = (
    (BEHAVIOUR, ("wdyy.t_ccr", "wdyy.c01_ccr", "wdyy_mrs.t_cc", "t_cc_cust", "wdyy.t_cc_cust", "ads.ads_risk_"), ()),
    (CREDIT, ("t_pbci", "wdyy_mrs.t_pbci", "wdyy.t_zxysblhs", "wdyy.v_md5_t_zxysblhs", "jsbrpt_mrs.zxbl_his"), ()),
    (MODEL, ("sykj1.model",), ()),
    (EXTERNAL, ("edap.", "ed", "ned", "jsbrpt_mrs.ods_02_all_zzxqsf"),
     ("度小满", "京东", "腾讯", "天创", "友盟", "同盾", "jsbrpt.v_ods_02_all_zzxqsf_md5", "unknown.unknown")),
)
#: Fixed values: (platform, prefixes, exact names), the first that fits holds.
PLATFORMS = (
    ("百融", ("edap.v_br", "edap.v_fqz_br"), ()),
    ("字节", ("wdyy.t_ccrdyyf", "wdyy.c01_ccrdyyf", "ned772"), ()),
    ("京东白条", ("wdyy.t_ccrbt", "wdyy_mrs.t_ccrbt"), ()),
    ("度小满", (), ("度小满",)),
    ("京东", (), ("京东",)),
    ("腾讯", (), ("腾讯",)),
    ("天创", (), ("天创",)),
    ("友盟", (), ("友盟",)),
    ("同盾", (), ("同盾",)),
    ("中征信", ("jsbrpt_mrs.ods_02_all_zzxqsf",), ("jsbrpt.v_ods_02_all_zzxqsf_md5",)),
    ("天辰", ("ed0509",), ()),
    ("友盟", ("ned0535",), ()),
    ("度小满", ("ed0223",), ()),
    ("同盾", ("ed0076",), ()),
    ("贷中行为变量-新底座", ("ads.ads_risk_",), ()),
    ("行为变量-消金", (), ("wdyy.T_CC_CUST_BEHAV_VARBL_INDEX",)),
    ("行为变量-总行", ("t_cc_cust", "wdyy.t_cc_cust", "wdyy_mrs.t_cc_cust"), ()),
    ("征信变量-消金", ("wdyy.t_zxysblhs", "wdyy.v_md5_t_zxysblhs", "jsbrpt_mrs.zxbl_his"), ()),
    ("征信变量-总行", ("t_pbci", "wdyy_mrs.t_pbci"), ()),
    ("模型分", ("sykj1.model",), ("暂无",)),
    ("外部数据", ("edap.", "ed", "ned"), ()),
    ("度小满", (), ("unknown.unknown",)),
)
#: Platforms whose tables are external data.
EXTERNAL_PLATFORMS = ("百融", "京东白条", "中征信", "天辰", "友盟", "度小满", "京东", "腾讯", "天创", "同盾", "外部数据")
#: Names that are likely keys or common fields and not variables.
LIKELY_KEYS = frozenset(
    "cust_id cust_no cert_no cert_num idcard apply_no data_dt dt rpt_id rpt_tm report_no reportno ci_rpt_id pboc_bs61_073 prd_big_cls_cd prd_sub_cls_cd "
    "prd_cd be_qry_nm be_qry_cert_num be_qry_cert_typ create_time update_time etl_dt etl_date insert_time modify_time op_dt".split()
)
#: Candidate join keys by kind of table.
CREDIT_KEYS = ["ci_rpt_id", "report_no", "reportno", "pboc_bs61_073"]
BEHAVIOUR_KEYS = ["cust_no", "cust_id"]
MODEL_KEYS = ["apply_no", "cust_no", "cert_no"]
PERSON_KEYS = ["cert_no", "cert_num", "idcard", "apply_no"]
PLATFORM_KEYS = ["apply_no", "cert_no", "cust_no"]
PARTITION = "dt"


def _first(table: str | None, rules) -> str:
    if not isinstance(table, str) or not table:
        return ""
    low = table.lower()
    return next((name for name, starts, names in rules if table in names or low.startswith(tuple(starts) or ("\0",))), "")


def category(table: str | None) -> str:
    """The category of a table, else an empty text."""
    return _first(table, CATEGORIES)


def platform(table: str | None) -> str:
    return _first(table, PLATFORMS)


def category_of_platform(name: str) -> str:
    """The category to take when a table's name tells none."""
    if name in EXTERNAL_PLATFORMS:
        return EXTERNAL
    for part, found in (("征信", CREDIT), ("行为", BEHAVIOUR)):
        if part in name:
            return found
    return MODEL if name == MODEL else UNKNOWN


def classify(table: str | None) -> tuple[str, str]:
    """(category, platform) with the fallback applied."""
    p = platform(table)
    return category(table) or category_of_platform(p), p


def excel_category(table: str, sheet: str = "") -> str:
    """The category of a table in a workbook: by its name, else by its sheet's."""
    found, _ = classify(table)
    if found != UNKNOWN:
        return found
    return next((c for c in (CREDIT, BEHAVIOUR, MODEL, EXTERNAL) if c[:2] in sheet), UNKNOWN)


@dataclass(frozen=True)
class Keys:
    primary: str
    candidates: list[str]
    partition: str = PARTITION


def join_keys(table: str, kind: str) -> Keys:
    """The join key, its candidates and the partition field by category, else by the table's name."""
    low = table.lower()
    if kind == CREDIT:
        by_report = "zxysblhs" in low or "zxbl" in low or "pbci" not in low
        return Keys("ci_rpt_id" if by_report else "report_no", list(CREDIT_KEYS))
    if kind == BEHAVIOUR:
        own = BEHAVIOUR_KEYS
    elif kind == MODEL:
        own = MODEL_KEYS
    elif "br" in low or "百融" in table or "zx" in low:
        own = PERSON_KEYS
    elif any(table in names and not starts for _, starts, names in PLATFORMS[3:9]):
        own = PLATFORM_KEYS
    else:
        own = [*PERSON_KEYS, "cust_no"]
    return Keys(own[0], list(own))


def likely_key(variable: str) -> bool:
    return variable.lower() in LIKELY_KEYS
