"""Template residue, filler, error messages and script notices in place of content.

No list of messages decides. Responses are told by what they do in the collection: the same low-information line comes
under several hosts and titles, shares no term with the titles and address slugs of its records, and hardly any with
the titles and slugs of the whole collection. A record is a case if every line of it is such a response, filler or
navigation; placeholder detectors read whole texts, since one unfilled placeholder is enough.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise

# What unfilled placeholders look like, where the name inside may be any word.
PLACEHOLDERS = [
    r"\{\{[^{}\n]{1,60}\}\}", r"\{%[^{}%\n]{1,60}%\}", r"<%=?[^<>%\n]{1,60}%>", r"[$#@]\{[^{}\n]{1,60}\}", r"\[\[[^\[\]\n]{1,60}\]\]",
    r"%[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*%", r"__[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*__", r"\[object [A-Z][A-Za-z]*\]",
    r"\[(?:INSERT|ENTER|ADD|YOUR|TODO|TBC|TBD|DATE|NAME|TITLE|PLACEHOLDER)(?: [A-Z]+)*\]", r"<(?:Your|Insert|Enter|Add)\b[^<>\n]{0,60}>",
    r"[\[【（(<](?:请|此处|在此|这里|待)[^\[\]【】（）()<>\n]{0,20}(?:输入|填写|补充|填入|填|上传|确认|插入|替换)[^\[\]【】（）()<>\n]{0,20}[\]】）)>]", r"(?:X{2,}|×{2,}|〇{2,})年(?:(?:X|×|〇)+月)",
]
# The words of the filler text that layouts come with.
LOREM = (
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo "
    "consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum"
)
QUOTES_BEFORE, QUOTES_AFTER = "“‘「『\"'`", "”’」』\"'`"
#: Hosts under which a line comes at least to be a repeated response, and the most it may share: of its terms with the titles and
#: slugs of its records, and with those of the collection, and of the titles of its records with each other.
HOSTS, MATCHED, FAMILIAR, ALIKE = 3, 0.05, 0.45, 0.6
#: Share of all records whose titles or slugs hold a term at least for it to be familiar.
TERM_SHARE = 5e-5
SLUG = r"^[a-z]+://[^/?#]+(/[^?#]*)"


def placeholder() -> str:
    """Pattern of a placeholder; one that stands in quotes is talked about, not left over."""
    return rf"(?=[{{$#@<\[%_【（(X×〇])(?<![{QUOTES_BEFORE}])(?:" + "|".join(PLACEHOLDERS) + rf")(?![{QUOTES_AFTER}])"


def terms(text: Column) -> Column:
    """The distinct Latin words of four letters or more and the pairs of adjacent Chinese characters."""
    han = F.regexp_extract_all(text, F.lit(r"[\p{IsHan}]{2,}"), F.lit(0))
    pairs = F.flatten(F.transform(han, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substr(r, i, F.lit(2)))))
    return F.array_distinct(F.concat(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z]{4,}"), F.lit(0)), pairs))


def _masked(line: Column) -> Column:
    """A line without case, numbers and hexadecimal ids."""
    return F.regexp_replace(F.lower(line), r"[a-f]*+\d[0-9a-f]*", "#")


def _is_nav(line: Column) -> Column:
    """Short items between separator signs."""
    return line.rlike(r"^[^。，；\d|/·»>＞]{1,24}(?:\s*[|/·»>＞]\s*[^。，；\d|/·»>＞]{1,24})+$")


def _is_filler(line: Column) -> Column:
    """One unit again and again, or words of filler text only."""
    words = LOREM.replace(" ", "|")
    latin = line.rlike(rf"(?i)^(?:(?:{words})\b[\s,.;]*){{3,}}$")
    # cheap test first: the start of a repeated unit comes again; the last unit may be cut
    unit = r"^([^\d|/·_=*-]{4,40}?)[\s.。,，!！]*(?:\1[\s.。,，!！]*)+(.*)$"
    again = F.contains(F.substr(line, F.lit(5)), F.substr(line, F.lit(1), F.lit(4))) & line.rlike(unit) & F.startswith(F.regexp_extract(line, unit, 1), F.regexp_extract(line, unit, 2))
    return latin | again


def _is_sentence(line: Column) -> Column:
    return line.rlike(r"[。；]|[a-z)%]\.(?:\s|$)") | (F.length(line) > 160)


def _lines(text: Column) -> Column:
    """The lines of a text that are neither blank nor navigation."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x.rlike(r"\S") & ~_is_nav(x))


def _empty(lines: DataFrame, key: list[str], forms: DataFrame) -> DataFrame:
    """(key, ...) of the rows without content, if lines of these forms (form) are none: filler without any sentence, or such lines only."""
    marked = lines.join(forms.select("form", F.lit(True).alias("idle")), "form", "left").withColumn("idle", F.coalesce("idle", F.lit(False)) | F.col("filler"))
    rows = marked.groupBy(*key).agg(F.bool_or("filler").alias("filler"), F.bool_or(F.col("sentence") & ~F.col("idle")).alias("told"), F.bool_and("idle").alias("only"))
    return rows.where("only or filler and not told").select(*key)


def _responses(texts: DataFrame, heads: DataFrame, names: DataFrame, lines: DataFrame, key: list[str], records: int) -> DataFrame:
    """(form): the masked lines of records without content that are responses of servers or templates."""
    spread = lines.groupBy("form", "host").agg(F.min(F.struct(*key)).alias("at")).groupBy("form").agg(F.count("host").alias("hosts"), F.min("at").alias("at"))
    spread = materialise(spread.where(F.col("hosts") >= HOSTS).select("form", "at"), "forms")
    # one record of each form gives its text; titles and slugs of all its records tell whether it has to do with them
    sample = texts.join(spread.select(*[F.col(f"at.{k}").alias(k) for k in key], "form"), key).select("form", F.explode(_lines(F.col("_text"))).alias("line"))
    sample = sample.where(F.col("form") == F.xxhash64(_masked(F.col("line")))).groupBy("form").agg(F.min("line").alias("line"))
    sample = materialise(sample.select("form", terms(F.col("line")).alias("terms")), "terms")
    known = terms(F.concat_ws("\n", "_title", F.regexp_extract("_address", SLUG, 1))).alias("known")
    familiar = names.select(F.explode(known).alias("term")).groupBy("term").agg(F.count("*").alias("rows")).where(F.col("rows") >= TERM_SHARE * records)
    asked = sample.select("form", F.explode("terms").alias("term"))
    share = asked.join(familiar, "term", "left").groupBy("form").agg(F.avg(F.col("rows").isNotNull().cast("int")).alias("familiar"))
    # records without a title or slug tell nothing
    held = lines.join(sample, "form").select(*key, "form", "terms").distinct().join(heads, key).dropDuplicates([*key, "form"])
    held = held.select("form", "terms", known).where("size(known) > 0")
    own = held.groupBy("form").agg(F.count("*").alias("n"), F.avg(F.size(F.array_intersect("known", "terms")) / F.greatest(F.size("terms"), F.lit(1))).alias("matched"))
    # reprints have titles alike
    of_titles = held.select("form", F.explode("known").alias("term")).groupBy("form", "term").agg(F.count("*").alias("n"))
    alike = of_titles.groupBy("form").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("per_term"))
    told = sample.join(share, "form", "left").join(own, "form", "left").join(alike, "form", "left")
    told = told.withColumn("alike", F.coalesce(F.col("per_term") / F.col("n"), F.lit(0.0)))
    return told.where((F.coalesce("familiar", F.lit(0.0)) <= FAMILIAR) & (F.coalesce("matched", F.lit(0.0)) <= MATCHED) & (F.col("alike") <= ALIKE)).select("form")


def residue(df: DataFrame, heads: Callable[[DataFrame], DataFrame], names: DataFrame, key: list[str], text: str, host: str, title: str, address: str) -> DataFrame:
    """Rows of key whose text carries residue, each once.

    heads gives the titles and addresses of rows of key, apart from the texts, which are not shuffled; names holds all
    titles and addresses of the collection, in any rows.

    Null, empty and blank texts are no cases; rows that come several times count once; a null host, title or
    address, or a key without a head, only weakens the host evidence. Texts and lines of any length are read whole. A message that
    comes under fewer than HOSTS hosts, or only with titles alike, is not told from content.
    """
    texts = df.where(F.col(text).rlike(r"\S")).select(*key, F.col(text).alias("_text"), F.col(host).alias("_host"))
    named = [F.col(title).alias("_title"), F.col(address).alias("_address")]
    # one pass over the texts leaves hashes and flags of lines only
    line = lambda x: F.struct(F.xxhash64(_masked(x)).alias("form"), _is_filler(x).alias("filler"), _is_sentence(x).alias("sentence"))
    flagged = texts.select(*key, F.xxhash64("_host").alias("host"), F.col("_text").rlike(placeholder()).alias("unfilled"), F.transform(_lines(F.col("_text")), line).alias("lines"))
    flagged = materialise(flagged, "residue")
    lines = flagged.select(*key, "host", F.explode("lines").alias("l")).select(*key, "host", "l.*")
    # only records all of whose content comes under several hosts can be cases; they are few, and what follows looks at them only
    spread = lines.select("form", "host").distinct().groupBy("form").agg(F.count("host").alias("hosts")).where(F.col("hosts") >= HOSTS)
    open_ = materialise(_empty(lines, key, materialise(spread.select("form"), "spread")), "open")
    own = materialise(lines.join(open_, key, "left_semi"), "open-lines")
    found = heads(open_).select(*key, *named)
    responses = materialise(_responses(texts.join(open_, key, "left_semi"), found, names.select(*named), own, key, flagged.count()), "responses")
    return flagged.where("unfilled").select(*key).unionByName(_empty(own, key, responses)).distinct()
