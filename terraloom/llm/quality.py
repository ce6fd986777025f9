"""Quality rules: base counts and divergence from language references, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise

#: Frequent function words of four languages, the bins of the word histogram.
COMMON_WORDS = (
    "the of and to in a is that it for was on be with as "
    "de la le et les des un une du que qui en est pour "
    "der die und den von zu das mit sich ein ist auf "
    "el y los se del las por con no su para es"
).split()
#: One letter for each bin, and one for all other words.
_CODES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
BLANK = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict. Distances are Jensen-Shannon distances to base 2, from 0 to 1; shorter texts than the guards
    aren't compared. The words' limit widens for short texts, whose histograms scatter: max_word_distance + word_slack /
    sqrt(words). `languages` bounds the references, which are pooled over all documents of a language with reference_words or more."""

    min_words: int = 20
    max_repeat_percent: int = 30
    guard_chars: int = 300
    guard_words: int = 20
    reference_words: int = 120
    max_char_distance: float = 0.28
    max_word_distance: float = 0.20
    word_slack: float = 1.2
    languages: tuple[str, ...] = field(default=("en", "de", "fr", "es"))


def words_of(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks."""
    trimmed = F.btrim(text, F.lit(BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def _kept_length(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _get(array: str, i: Column) -> Column:
    return F.get(F.col(array), i)


def features(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The carried columns and, for each row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    chars and words (array<long>, the histograms). A null text has no words. Rows are independent."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(*carry, text.alias("__t"))
    df = df.withColumn("__w", words_of(F.col("__t"))).withColumn("__n", F.size("__w"))
    eight = lambda i: [_get("__w", i + k) for k in range(8)]
    spans = F.sequence(F.lit(0), F.col("__n") - 8)
    df = df.withColumn("__h", F.when(F.col("__n") >= 8, F.transform(spans, lambda i: F.xxhash64(*eight(i)))))
    twice = F.size(F.array_distinct("__h")) < F.size("__h")
    df = df.withColumn("__s", F.when(twice, F.sort_array(F.transform(spans, lambda i: F.struct(F.concat_ws(" ", *eight(i)).alias("w"), i.alias("i"))))))
    same = lambda s, k: _get("__s", k)["w"].eqNullSafe(s["w"])
    df = df.withColumn("__p", F.array_sort(F.transform(F.filter("__s", lambda s, k: same(s, k - 1) | same(s, k + 1)), lambda s: s["i"])))
    covered = F.aggregate("__p", F.struct(F.lit(0).alias("n"), F.lit(-8).alias("last")), lambda a, p: F.struct((a["n"] + F.least(F.lit(8), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    lines = F.filter(F.split("__t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    df = df.withColumn("__l", lines)
    plain = F.transform("__w", lambda w: F.lower(F.btrim(w, F.lit(".,"))))
    codes = F.array_join(F.transform(F.filter(plain, lambda w: w.isin(COMMON_WORDS)), lambda w: F.substr(F.lit(_CODES), F.array_position(F.array(*map(F.lit, COMMON_WORDS)), w).cast("int"), F.lit(1))), "")
    df = df.withColumn("__c", codes)
    count = lambda c: (F.length("__c") - F.length(F.replace(F.col("__c"), F.lit(c), F.lit("")))).cast("long")
    bins = [count(c) for c in _CODES[: len(COMMON_WORDS)]]
    df = df.withColumn("__r", F.regexp_replace("__t", "[a-z\\x20\\x09-\\x0D]+", ""))  # a small part of a text has the rarer classes
    solid = F.length(F.array_join("__w", "")).cast("long")
    n_symbols = _kept_length(F.col("__r"), "[^#*$%&|<>]+")
    upper, digit, wide = (_kept_length(F.col("__r"), f"[{c}]+") for c in ("^A-Z", "^0-9", "\\x00-\\x7F"))
    marks = _kept_length(F.col("__r"), "[^!\"'()+,\\-./:;=?@\\[\\\\\\]^_`{}~]+")
    df = df.select(*carry, F.col("__n").cast("long").alias("n_words"), F.length("__t").cast("long").alias("__len"), solid.alias("word_chars"), n_symbols.alias("n_symbols"), (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), wide.alias("__wi"), upper.alias("__up"), digit.alias("__di"), marks.alias("__ma"), F.array(*bins).alias("__b"), F.length("__c").cast("long").alias("__k"))
    lower = F.col("word_chars") - F.col("__up") - F.col("__di") - F.col("__ma") - F.col("n_symbols") - F.col("__wi")
    chars = F.array(lower, "__up", "__di", "__ma", "n_symbols", F.col("__len") - F.col("word_chars"), "__wi")
    return df.select(*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", chars.alias("chars"), F.concat("__b", F.array(F.col("n_words") - F.col("__k"))).alias("words"))


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)


def references(found: DataFrame, lang_col: str, rules: Rules) -> list[tuple[list[int], list[int]]]:
    """Pooled histograms over all documents of each language that pass the base rules and the guard: a few rows."""
    size = 7, len(COMMON_WORDS) + 1
    sums = [F.sum(F.col(c)[i]).alias(f"{c}{i}") for c, n in zip(("chars", "words"), size) for i in range(n)]
    ok = found.where(F.col(lang_col).isin(*rules.languages) & ~base_failed(rules) & (F.col("n_words") >= rules.reference_words))
    rows = ok.groupBy(lang_col).agg(*sums).orderBy(lang_col).collect()
    return [([r[f"chars{i}"] for i in range(size[0])], [r[f"words{i}"] for i in range(size[1])]) for r in rows]


def distance(histogram: str, reference: list[int]) -> Column:
    """Jensen-Shannon distance of an array<long> column from a reference of the same bins."""
    total = float(sum(reference)) or 1.0
    shares = F.array(*[F.lit(x / total) for x in reference])
    own = F.aggregate(histogram, F.lit(0).cast("long"), lambda a, x: a + x).cast("double")
    half = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(F.transform(histogram, lambda x: x / own), shares, lambda p, q: half(p, (p + q) / 2) + half(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def judge(found: DataFrame, refs: list[tuple[list[int], list[int]]], rules: Rules) -> DataFrame:
    """found with char_distance and word_distance to the nearest reference, base_failed and kept.
    Without references, and below the guards, distances don't count (null)."""
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    nearest = lambda col, k: F.array_min(F.array(*[distance(col, r[k]) for r in refs])) if refs else F.lit(None).cast("double")
    found = found.withColumn("char_distance", F.when(n_chars >= rules.guard_chars, nearest("chars", 0)))
    found = found.withColumn("word_distance", F.when(F.col("n_words") >= rules.guard_words, nearest("words", 1)))
    verdict = (F.coalesce("char_distance", F.lit(0.0)) <= rules.max_char_distance) & (F.coalesce("word_distance", F.lit(0.0)) <= rules.max_word_distance + rules.word_slack / F.sqrt("n_words"))
    return found.withColumn("base_failed", base_failed(rules)).withColumn("kept", ~F.col("base_failed") & verdict)


def quality(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """One row per row of docs: doc_id, text_hash, the base counts, char_distance, word_distance, base_failed, kept.

    A document is held against the nearest of all references, so that a null or wrong language costs it
    nothing. Null texts have no words and fail the base rules; texts of any length are read whole; null ids and repeated
    rows return like any other; other columns play no part; an empty table gives an empty one. Texts are read once: the counts are written to the shared
    folder, the references summed from them.
    """
    keys = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    found = materialise(features(keys, "text", ("doc_id", "text_hash", "lang")))
    return judge(found, references(found, "lang", rules), rules).drop("chars", "words", "lang")


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """docs without the documents that the rules reject; all columns stay. The verdict depends on the text alone."""
    bad = quality(docs, rules, text_col, id_col, lang_col).where(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(bad, docs[id_col].cast("long").eqNullSafe(bad["__id"]) & (F.xxhash64(docs[text_col].cast("string")) == bad["__hash"]), "left_anti")


def oracle(rules: Rules = Rules()) -> str:
    """DuckDB SQL for quality()'s contract columns over documents."""
    vocab = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    n = len(COMMON_WORDS)
    langs = ", ".join(f"'{x}'" for x in rules.languages)
    kept = lambda keep: f"length(regexp_replace(t, '{keep}', '', 'g'))"
    jsd = lambda h, r: f"sqrt(greatest(list_sum(list_transform(range(1, len({h}) + 1), lambda i: (CASE WHEN {h}[i] > 0 THEN {h}[i] * log2({h}[i] / (({h}[i] + {r}[i]) / 2)) ELSE 0 END) + (CASE WHEN {r}[i] > 0 THEN {r}[i] * log2({r}[i] / (({h}[i] + {r}[i]) / 2)) ELSE 0 END))) / 2, 0))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
pos AS (SELECT rid, unnest(range(0, len(ws) - 7)) AS i, ws FROM w WHERE len(ws) >= 8),
win AS (SELECT rid, i, ws[i + 1:i + 8] AS g FROM pos),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT l) AS n_dup FROM ln WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
f AS (SELECT w.rid, doc_id, lang, len(ws)::BIGINT AS n_words, {kept('[\\x20\\x09-\\x0D]+')}::BIGINT AS word_chars,
  {kept('[^#*$%&|<>]+')}::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
  length(t) AS n_chars, {kept('[\\x00-\\x7F]+')} AS wi, {kept('[^A-Z]+')} AS up, {kept('[^0-9]+')} AS di, {kept('[^!"' + "''" + '()+,\\-./:;=?@\\[\\\\\\]^_`{}~]+')} AS ma,
  list_filter(list_transform(ws, lambda x: lower(trim(x, '.,'))), lambda x: x IN ({vocab})) AS cw
  FROM w LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid)),
h AS (SELECT *, [word_chars - up - di - ma - n_symbols - wi, up, di, ma, n_symbols, n_chars - word_chars, wi] AS hc,
  list_append(list_transform([{vocab}], lambda v: len(list_filter(cw, lambda x: x = v))), n_words - len(cw)) AS hw,
  n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM f),
ref AS (SELECT lang, [{", ".join(f"sum(hc[{i}])" for i in range(1, 8))}] AS rc, [{", ".join(f"sum(hw[{i}])" for i in range(1, n + 2))}] AS rw
  FROM h WHERE lang IN ({langs}) AND NOT base_failed AND n_words >= {rules.reference_words} GROUP BY lang),
rs AS (SELECT list_transform(rc, lambda x: x / list_sum(rc)::DOUBLE) AS rc, list_transform(rw, lambda x: x / list_sum(rw)::DOUBLE) AS rw FROM ref),
p AS (SELECT rid, list_transform(hc, lambda x: x / nullif(n_chars, 0)::DOUBLE) AS pc, list_transform(hw, lambda x: x / nullif(n_words, 0)::DOUBLE) AS pw FROM h),
dist AS (SELECT rid, min({jsd('pc', 'rc')}) AS dc, min({jsd('pw', 'rw')}) AS dw FROM p, rs GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (n_chars < {rules.guard_chars} OR coalesce(dc, 0) <= {rules.max_char_distance}) AND (n_words < {rules.guard_words} OR coalesce(dw, 0) <= {rules.max_word_distance} + {rules.word_slack} / sqrt(n_words)) AS kept
FROM h LEFT JOIN dist USING (rid)"""
