"""Text expressions: all JVM-side columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of pages that block readers instead of showing content.
BLOCK_MARKERS = ["验证码", "访问过于频繁", "系统检测到异常访问", "请求被拒绝", "请登录后查看", "javascript is required", "enable javascript", "access denied", "robot check"]
# Address parameters that only track; those that start with utm_ do as well.
TRACKING = ["from", "spm", "source", "ref", "referrer", "campaign", "mc_cid", "mc_eid"]
# Units that make a number material, longer ones before their parts.
UNITS = ["%", "％", "万元", "亿元", "万家", "万台", "万套", "万平方米", "万", "亿", "家", "个", "项", "条", "人", "台", "套", "平方米"]
# Endings of region names that their short names leave out.
REGION_ENDINGS = ["壮族自治区", "回族自治区", "维吾尔自治区", "自治区", "省", "市"]
# The country, words of queries that concern all of it, and its regions in their usual order.
COUNTRY = "全国"
NATIONAL_WORDS = ["全国", "国务院", "国家", "中央", "工信部"]
REGIONS = (
    "北京市 天津市 河北省 山西省 内蒙古自治区 辽宁省 吉林省 黑龙江省 上海市 江苏省 浙江省 安徽省 福建省 江西省 山东省 河南省 湖北省 湖南省 广东省 "
    "广西壮族自治区 海南省 重庆市 四川省 贵州省 云南省 西藏自治区 陕西省 甘肃省 青海省 宁夏回族自治区 新疆维吾尔自治区"
).split()
# Terms too general to anchor a phrase.
GENERIC_TERMS = ["制造", "产业", "服务", "系统", "产品", "设备", "软件", "技术", "材料", "研发", "智能", "新型", "高端", "先进", "创新", "建设", "平台", "应用", "科技"]


#: Blanks within a line, spelled out so that the JVM and SQL engines agree.
BLANKS = r"[\t\x0b\f\r \x85\p{Z}]"
#: Blanks of any kind, and the ends of lines.
WIDE = r"[\t\n\x0b\f\r \x{85}\p{Z}]"
LINE_ENDS = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"
EDGES = r"^[\t\n\x0b\f\r \x85\p{Z}]+|[\t\n\x0b\f\r \x85\p{Z}]+$"


def strip(text: Column) -> Column:
    """The text without blanks of any kind at its ends."""
    return F.regexp_replace(text, EDGES, "")


def clean_lines(text: Column) -> Column:
    """No-break spaces to spaces, zero-width spaces away, blanks collapsed in each line, blank lines dropped."""
    flat = F.regexp_replace(F.replace(text, F.lit(" "), F.lit(" ")), "​", "")
    lines = F.transform(F.split(flat, "\n"), lambda x: strip(F.regexp_replace(x, BLANKS + "+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def quality_gate(text: Column, least: int, scanned: bool = False) -> tuple[Column, Column]:
    """(status, reason) of a page text: empty, blocked, short, without any paragraph, or usable; the first that fits.

    An empty or short text of a scanned document needs character recognition, any other unusable text another reader.
    """
    t = F.coalesce(text, F.lit(""))
    flat = strip(F.regexp_replace(t, WIDE + "+", " "))
    size = F.length(flat)
    blocked = F.lit(False)
    for m in BLOCK_MARKERS:
        blocked = blocked | F.contains(F.lower(flat), F.lit(m))
    bare = (size > 1200) & ~F.exists(F.split(t, LINE_ENDS, -1), lambda x: F.length(strip(x)) >= 30)
    reason = (
        F.when(size == 0, "empty_body").when(blocked, "access_or_javascript_placeholder").when(size < least, "body_below_minimum_length")
        .when(bare, "no_substantive_paragraphs").otherwise("ok")
    )
    missing = reason.isin("empty_body", "body_below_minimum_length")
    return F.when(reason == "ok", "usable").when(missing & F.lit(scanned), "ocr_required").otherwise("remote_reader_required"), reason


def evidence_form(text: Column) -> Column:
    """Letters and digits only, lower case, citation marks away."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, r"\^?\[\d+\]\^?", ""), r"[^\p{L}\p{N}]", ""))


def identity_form(text: Column) -> Column:
    """A name without anything but letters, digits and underscores, case folded (sharp s as ss)."""
    return F.replace(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}_]", "")), F.lit("ß"), F.lit("ss"))


NUMBER = r"\d+(?:\.\d+)?" + WIDE + "*(?:" + "|".join(UNITS) + ")"


def material_numbers(text: Column) -> Column:
    """The numbers with a unit in a text, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)))


def clipped(text: Column, size: int, head: float = 0.72) -> Column:
    """The head and the tail of a text longer than size, with an ellipsis between."""
    front = int(size * head)
    back = size - front - 1
    return F.when(F.length(text) <= size, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, front)), F.lit("…"), F.substr(text, F.length(text) - back + 1)))


def _form_encoded(c: Column) -> Column:
    """Percent encoding of a form value; letters, digits and -._~ stay."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, user and fragment, no tracking parameters whatever their case.

    The other parameters are decoded, sorted by name and value, and encoded again; one without a value gets an empty one, and
    one that can't be decoded stays as it is. Null if the address is not http or https.
    """
    pattern = r"^(?i)(https?)://(?:[^/?#@]*@)?([^/?#:@]+)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    plain = strip(url)
    part = lambda i: F.regexp_extract(plain, pattern, i)
    decoded = lambda c: F.coalesce(F.try_url_decode(c), c)
    cut = lambda p: F.struct(decoded(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), decoded(F.when(F.contains(p, F.lit("=")), F.substr(p, F.instr(p, "=") + 1)).otherwise("")).alias("v"))
    pairs = F.transform(F.filter(F.split(part(5), "&"), lambda p: p != ""), cut)
    keep = F.filter(pairs, lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(*TRACKING))
    query = F.array_join(F.transform(F.array_sort(keep), lambda p: F.concat(_form_encoded(p["k"]), F.lit("="), _form_encoded(p["v"]))), "&")
    scheme, port = F.lower(part(1)), part(3)
    own_port = F.when((port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")), "").otherwise(F.concat(F.lit(":"), port))
    path = F.when(part(4) == "", "/").otherwise(part(4))
    return F.when(plain.rlike(pattern), F.concat(scheme, F.lit("://"), F.lower(part(2)), own_port, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?i)https?://([^/?#:]+)", 1))


def grams(text: Column, n: int) -> Column:
    """The distinct n-grams of characters."""
    size = F.length(text)
    return F.when(size >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substr(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def all_grams(text: Column, sizes: tuple[int, ...] = (2, 3)) -> Column:
    """The n-grams of characters of several sizes, as often as they come."""

    def of(n: int) -> Column:
        last = F.length(text) - n + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of, sizes))


def fingerprint(*fields: tuple[str, Column]) -> Column:
    """SHA-256 of the canonical JSON of named values, whose names come sorted; null fields are kept."""
    row = F.struct(*[c.alias(n) for n, c in sorted(fields)])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def anchor(phrase: Column, names: list[Column], generic: list[str], least: int = 2) -> Column:
    """The longest part of phrase of at least least characters that stands in one of names and is no generic term.

    Case doesn't matter. The first of equals; null if there is none.
    """
    p = F.lower(strip(phrase))
    size = F.length(p)
    parts = F.flatten(F.transform(F.sequence(F.lit(0), size - least), lambda cut: F.transform(F.sequence(F.lit(1), cut + 1), lambda i: F.substr(p, i, size - cut))))

    def fits(part: Column) -> Column:
        inside = F.lit(False)
        for n in names:
            inside = inside | F.contains(F.coalesce(F.lower(n), F.lit("")), part)
        return inside & ~part.isin(*generic)

    return F.when((size >= least) & ~p.isin(*generic), F.get(F.filter(parts, fits), F.lit(0)))


def linked(text: Column, thing: str, actions: list[str], span: int = 60) -> Column:
    """Whether an action word stands within span characters of thing, in the same sentence."""
    near = rf"[^。；\n]{{0,{span}}}"
    words = "(?:" + "|".join(actions) + ")"
    return text.rlike(rf"{words}{near}\Q{thing}\E|\Q{thing}\E{near}{words}")


def scrubbed_query(query: Column, region: Column) -> Column:
    """A search query without date words, blanks collapsed, with its region in front if it names none."""
    plain = strip(F.regexp_replace(F.regexp_replace(query, r"\d{4}年(?:\d{1,2}月)?(?:\d{1,2}日)?|\d{4}-\d{1,2}(?:-\d{1,2})?", " "), BLANKS + "+", " "))
    return F.when(region.isNull() | F.coalesce(F.contains(plain, region), F.lit(False)), plain).otherwise(F.concat(region, F.lit(" "), plain))


def region_alias(region: Column) -> Column:
    """The short name of a region; 区 and 县 are part of a name."""
    return F.regexp_replace(region, "(?:" + "|".join(REGION_ENDINGS) + ")$", "")


def is_regional(query: Column, region: Column) -> Column:
    """Whether a query concerns a region: by its short name, or by a word for the whole country."""
    national = F.lit(False)
    for w in NATIONAL_WORDS:
        national = national | F.contains(query, F.lit(w))
    return F.when(region == COUNTRY, national).otherwise(F.contains(query, region_alias(region)))


def expanded_scope(regions: Column) -> Column:
    """Regions, each once, in order; the country comes first and brings all its regions."""
    whole = F.concat(F.array(F.lit(COUNTRY), *[F.lit(r) for r in REGIONS]), regions)
    return F.array_distinct(F.when(F.array_contains(regions, COUNTRY), whole).otherwise(regions))


# Signs that names of companies are compared without, and phrases of profiles that only repeat a register.
NAME_SIGNS = r"[·•・,，.。()（）\[\]【】]"
REGISTER_PHRASES = ["成立于", "法定代表人为", "注册资本为", "统一社会信用代码为", "企业注册地址位于", "所属行业为", "经营范围包含", "企业当前经营状态为"]


def company_form(name: Column) -> Column:
    """A company name without blanks and signs, in lower case; empty for null."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), WIDE + "+", ""), NAME_SIGNS, ""))


def is_register_profile(text: Column, least: int = 3) -> Column:
    """Whether a profile has at least least of the phrases of a register; false for null."""
    found = sum((F.contains(text, F.lit(p)).cast("int") for p in REGISTER_PHRASES[1:]), F.contains(text, F.lit(REGISTER_PHRASES[0])).cast("int"))
    return F.coalesce(found >= least, F.lit(False))


def json_object(text: Column) -> Column:
    """The text if it is JSON, else what stands between its first and last brace if that is, else null."""
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    valid = lambda c: F.call_function("try_parse_json", c).isNotNull()
    return F.when(valid(text), text).when((inner != "") & valid(inner), inner)


def normal_term(text: Column) -> Column:
    """NFKC, lower case, letters and digits only; Spark has no normaliser, so batches go through Python."""
    @F.pandas_udf("string")
    def nfkc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return F.regexp_replace(F.lower(nfkc(text)), r"[^\p{L}\p{N}]", "")
