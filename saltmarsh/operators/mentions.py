"""Names of a dictionary in texts, by joins: no limit on names, no Python workers.

Texts and names are cut into runs of letters and digits. A name's anchor is the one of its runs that fewest names have: wherever the name stands, some run of the text holds the anchor. Only
the texts' distinct runs are joined with the anchors, by pieces of theirs that are as long as anchors are; the runs that hold
one are few, and lead back to the texts, where each name is looked for as a whole. A name without a letter or digit is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import stored

# Characters of words, what may follow a name in its word, and titles behind a name that is no mention.
TOKEN = "0-9A-Za-z가-힣"
POSTFIXES = (
    "은", "는", "이", "가", "을", "를", "과", "와", "도", "만", "의", "에", "엔", "에서", "에게", "께", "으로", "로",
    "부터", "까지", "처럼", "보다", "뿐", "뿐만", "이나", "나", "랑", "하고", "마다", "씩", "조차", "마저", "라도",
    "이라", "라", "이며", "이다", "이었다", "였다", "으로는", "로는", "에는", "에서의", "에서도", "에는서", "와의", "과의",
)
ANALYSTS = (" 연구원", " 수석연구원", " 애널리스트", " 리서치센터", " 센터장", " 전략가", " 연구위원")
#: Characters of an anchor that are looked for within runs; the anchor itself is compared afterwards.
PIECE = 12
#: What stands around a match while a line is cut, and in its place where a line has it.
FROM, TO, OTHER = "\x01", "\x02", "\x03"


def _runs(text: Column | str) -> Column:
    return F.filter(F.split(text, f"[^{TOKEN}]+"), lambda r: r != "")


def contained(texts: DataFrame, names: DataFrame) -> DataFrame:
    """id, text and found (a set of names) of texts (id, text) that contain a name, anywhere; rows of one id are one text's.

    Null texts contain nothing; null names and names without a letter or digit are none.
    """
    runs = names.select("name").distinct().select("name", F.explode(F.array_distinct(_runs("name"))).alias("run"))
    rare = runs.join(runs.groupBy("run").count(), "run")  # a run that half of all names have says little
    words = rare.groupBy("name").agg(F.min_by("run", F.struct("count", -F.length("run"), "run")).alias("anchor"))
    words = stored(words.withColumn("piece", F.substring("anchor", 1, PIECE)), "anchors")
    lengths = sorted(r[0] for r in words.select(F.length("piece")).distinct().collect())  # PIECE rows at most
    pairs = texts.select("id", F.explode(F.array_distinct(_runs("text"))).alias("run"))
    if not lengths:
        return texts.select("id", "text", F.array().cast("array<string>").alias("found")).limit(0)

    def pieces(n: Column) -> Column:
        last = F.length("run") - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring("run", i, n))).otherwise(F.array().cast("array<string>"))

    every = F.flatten(F.transform(F.array(*[F.lit(n) for n in lengths]), pieces))
    keyed = pairs.select("run").distinct().select("run", F.explode(F.array_distinct(every)).alias("piece"))
    held = stored(keyed.join(words, "piece").where(F.contains("run", "anchor")).select("run", "name").distinct(), "runs")
    hits = pairs.join(held, "run").groupBy("id").agg(F.collect_set("name").alias("names"))
    found = texts.join(hits, "id").select("id", "text", F.filter("names", lambda n: F.contains("text", n)).alias("found"))
    return found.where(F.size("found") > 0)


def names_in(texts: DataFrame, names: DataFrame, most: int = 5) -> DataFrame:
    """id, name of at most ``most`` names contained in a text (id, text), by name."""
    rows = contained(texts, names).withColumn("found", F.slice(F.array_sort("found"), 1, most))
    return rows.select("id", F.explode("found").alias("name"))


def _any_of(words) -> str:
    return "^(?:" + "|".join(words) + ")"


def mentions(texts: DataFrame, universe: DataFrame) -> DataFrame:
    """id, kind (0 by name, 1 by code), line, place and code of each stock (code, name) that a text (id, text) mentions, repeats too.

    A line is scanned from left to right; of the names at one place the longest is taken, and the scan goes on behind it. It counts between signs
    or ends of words, or before a postfix, and not where an analyst's title follows. Six digits between other characters are a code, if it is one.
    Of two codes with one name the smaller counts. Names have no line breaks. Where the universe has a column ``by_code``, only codes of its
    rows that are true there are looked for as digits: others are numbers of a list and mean nothing in a text.
    """
    listed = universe.where("name <> '' and code <> ''")
    lines = texts.select(F.col("id").alias("of"), F.posexplode(F.split("text", "\n")).alias("line", "text")).select(F.struct("of", "line").alias("id"), F.translate("text", FROM + TO, OTHER * 2).alias("text"))
    found = contained(lines, listed.select("name"))
    # the longest first: a pattern takes the first of its choices that fits
    by_length = F.array_sort("found", lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    pattern = F.concat(F.lit("("), F.array_join(F.transform(by_length, lambda n: F.concat(F.lit(r"\Q"), F.replace(n, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))), "|"), F.lit(")"))
    parts = found.withColumn("parts", F.split(F.regexp_replace("text", pattern, F.lit(f"{FROM}$1{TO}")), FROM))

    def whole(c: Column) -> Column:
        return F.translate(c, TO, "")

    def match(k: Column) -> Column:
        part = F.get("parts", k)
        # every part but the first has a character at least, so so many hold all that is asked for
        behind = F.concat(F.substring_index(part, TO, -1), whole(F.array_join(F.slice("parts", k + 2, 17), "")))
        return F.struct(k.alias("place"), F.substring_index(part, TO, 1).alias("name"), F.right(whole(F.get("parts", k - 1)), F.lit(1)).alias("before"), F.substring(behind, 1, 16).alias("behind"))

    places = F.when(F.size("parts") > 1, F.transform(F.sequence(F.lit(1), F.size("parts") - 1), match))
    met = parts.select("id", F.explode(places).alias("m")).select("id.of", "id.line", "m.*")
    free = ~F.col("before").rlike(f"[{TOKEN}]") & (~F.col("behind").rlike(f"^[{TOKEN}]") | F.col("behind").rlike(_any_of(POSTFIXES)))
    met = met.where(free & ~F.col("behind").rlike(_any_of(ANALYSTS)))
    codes = listed.groupBy("name").agg(F.min("code").alias("code"))
    by_name = met.join(codes, "name").select(F.col("of").alias("id"), F.lit(0).alias("kind"), "line", "place", "code")
    digits = texts.select("id", F.posexplode(F.regexp_extract_all("text", F.lit(r"(?<!\d)\d{6}(?!\d)"), F.lit(0))).alias("place", "code"))
    written = listed.where("by_code") if "by_code" in listed.columns else listed
    by_code = digits.join(written.select("code").distinct(), "code", "left_semi").select("id", F.lit(1).alias("kind"), F.lit(0).alias("line"), "place", "code")
    return by_name.unionByName(by_code)


def with_mentions(docs: DataFrame, universe: DataFrame, key: str = "doc_id", text: str = "text", into: str = "symbols") -> DataFrame:
    """docs with the distinct codes of the stocks that each text mentions, those by name first, in order of their places; rows of one key are one text's."""
    first = Window.partitionBy("id", "code").orderBy("kind", "line", "place")
    rows = mentions(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), universe).withColumn("r", F.row_number().over(first)).where("r = 1")
    lists = rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("kind", "line", "place", "code"))), lambda m: m["code"]).alias("_mentioned"))
    joined = docs.join(lists.withColumnRenamed("id", "_of"), F.col(key) == F.col("_of"), "left")
    return joined.withColumn(into, F.coalesce("_mentioned", F.array().cast("array<string>"))).drop("_mentioned", "_of")
