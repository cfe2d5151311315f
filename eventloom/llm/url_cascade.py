"""URL rules by a cascade of Bloom filters that is exact over the keys of the corpus.

A URL's keys are the suffixes of its host with as many labels as a rule has, each joined with the beginning of its path
at that rule's length. A rule fits a URL exactly if it is among these keys, so their number follows the rules' forms and
not the host's labels. The cascade answers that without a join: level 1 is a Bloom
filter of the listed keys, level 2 one of the unlisted keys of the corpus that level 1 lets through, level 3 one of
the listed keys that level 2 lets through, and so on until none is left. A key is listed if the first level that
does not hold it is an even one. Since the levels were built over all keys of the corpus, no key is judged wrongly.
One cascade is built for the rules of each verdict. Its bits are bounded by the list: the first level lets through
about as many unlisted keys as there are listed ones, whatever the corpus's size.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import table
from eventloom.session import materialize

#: The rules of the registered query: host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of all levels together that may be sent to every executor as literals.
MOST_BITS = 1 << 23


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: both empty for null and where ``://`` is missing."""
    found = F.instr(url, "://") > 0
    rest = F.when(found, F.substr(url, F.instr(url, "://") + F.lit(3)))
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^?#]*)", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/]*(/?[\s\S]*)$", 1)


def keys_of(host: Column, path: Column, forms: Sequence[tuple[int, int]]) -> Column:
    """Array of keys: for each form of a rule (labels, path length) the URL's last labels and the start of its path."""
    dots = F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit("")))
    keys = [
        F.when((dots >= labels - 1) & (F.char_length(path) >= n), F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, n)))
        for labels, n in forms
    ]
    return F.filter(F.array(*keys), lambda k: k.isNotNull())


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _holds(key: Column, level: int, filter_: tuple[int, int, list[int]]) -> Column:
    bits, hashes, words = filter_
    array, found = F.array(*[F.lit(w).cast("long") for w in words]), F.lit(True)
    for at in _positions(key, level, bits, hashes):
        word = F.element_at(array, (F.shiftright(at, 6) + 1).cast("int"))
        found = found & (F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
    return found


def _build(keys: DataFrame, level: int, bits: int, hashes: int) -> tuple[int, int, list[int]]:
    """The filter's words; at most bits / 64 of them come to the driver."""
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("at"))
    one = F.expr("shiftleft(1L, CAST(pmod(at, 64) AS INT))")
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("set")).collect()
    filled = [0] * ceil(bits / 64)
    for row in words:
        filled[row["word"]] = row["set"]
    return bits, hashes, filled


def build_cascade(universe: DataFrame, listed: Column, most_bits: int = MOST_BITS) -> list[tuple[int, int, list[int]]]:
    """Levels for ``universe`` (distinct ``key``), of which those that satisfy ``listed`` are the list."""
    keys = universe.select("key", listed.alias("listed"))
    size = keys.agg(F.count_if("listed"), F.count(F.lit(1))).first()
    levels: list[tuple[int, int, list[int]]] = []
    if not size[0]:
        return levels
    inside, outside = size[0], max(1, size[1] - size[0])
    rate = min(0.5, inside / outside)
    source, against, rows, spent = keys.filter("listed"), keys.filter("NOT listed"), inside, 0
    while rows:
        hashes = max(1, round(-log2(rate)))
        bits = 64 * ceil(max(64, rows * -log(rate) / log(2) ** 2) / 64)
        spent += bits
        if spent > most_bits:
            raise ValueError(f"the cascade needs over {most_bits} bits; split the list by key hash and build one cascade each")
        level = len(levels) + 1
        levels.append(_build(source, level, bits, hashes))
        left = materialize(against.filter(_holds(F.col("key"), level, levels[-1])))
        source, against, rows, rate = left, source, left.count(), 0.5
    return levels


def is_listed(key: Column, levels: list[tuple[int, int, list[int]]]) -> Column:
    """Whether a key of the universe is on the list: the first level without it has an even number."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in range(len(levels), 0, -1):
        answer = F.when(~_holds(key, level, levels[level - 1]), F.lit(level % 2 == 0)).otherwise(answer)
    return answer


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    ``rules``: host, path, verdict (allow or block). A rule fits its host and all subdomains if the path starts
    with the rule's; the longest fitting rule decides, then the one with the longer host. Where none fits, the key
    is on no list and the verdict is ``default``. Null URLs and those without ``://`` have empty host and path.
    Rules given twice count once; of rules that differ in the verdict only, block holds. Rules without host or path
    fit nothing. Repeated rows are each judged; hosts may have any number of labels and urls any length. An empty
    table gives an empty result. Other columns are not read.
    """
    host, path = split_url(F.col(url_col))
    parts = materialize(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")))
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    labels = F.size(F.split("host", r"\."))
    forms = sorted(tuple(r) for r in rules.filter("host IS NOT NULL AND path IS NOT NULL").select(labels, F.char_length("path")).distinct().collect())
    if not forms:
        return parts.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    own = keys_of(F.col("host"), F.col("path"), forms)
    corpus = parts.select("host", "path").distinct().select(F.explode(own).alias("key"))
    marked = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.max("verdict").alias("verdict"))
    # Rules and corpus meet in one aggregation by key, so marking the listed keys needs no join either.
    nothing = F.lit(None).cast("string")
    universe = corpus.select("key", nothing.alias("verdict")).unionByName(marked).groupBy("key").agg(F.max("verdict").alias("verdict"))
    universe = materialize(universe)
    cascades = {v: build_cascade(universe, F.col("verdict").eqNullSafe(v)) for v in ("allow", "block")}
    verdict = {v: (lambda k, v=v: is_listed(k, cascades[v])) for v in cascades}
    fits = F.filter(own, lambda k: verdict["allow"](k) | verdict["block"](k))
    ranked = F.transform(fits, lambda k: F.struct(F.char_length(k).alias("length"), F.coalesce(F.nullif(F.instr(k, "/"), F.lit(0)), F.char_length(k)).alias("host"), k.alias("key")))
    judged = parts.withColumn("rule", F.array_max(ranked).getField("key"))
    rule = F.col("rule")
    answer = F.when(rule.isNull(), F.lit(default)).when(verdict["block"](rule), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", answer.alias("verdict"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    values = ", ".join("('" + "', '".join(x.replace("'", "''") for x in r) + "')" for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")


def op6_url_cascade(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark))


SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^([^?#]*)', 1) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '' END AS path
  FROM rest),
judged AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""
