"""Personal data by fixed patterns and by bootstrapped contextual extraction, with DataFrame functions only.

Fixed patterns give the base spans. The instances that contexts can point to are words with a digit or ``@``, and stretches in the form of a
card or phone, blanks included; those that hold a base entity are the seeds. Each occurrence of an instance stands in up to three lexical
patterns: the word before it, the word after it, and both. The graph of patterns and instances, counted over all
documents, is scored in rounds: a pattern by the mean score of its distinct instances (one more, of score 0, is added to each), an
instance by the chance that not all of its trusted patterns are wrong; a seed's score is 1. A pattern is trusted if its score is
``CONFIDENT`` or more and at least ``SUPPORT`` of its instances, seeds or others, have that score too. Scores only rise, and
the rounds end when none does by more than ``SETTLED``. Instances with a score of ``CONFIDENT`` or more that are no seeds are
identifiers not seen by the fixed patterns: spans of kind ``context``, wherever they stand.

The fixed patterns are possessive or bounded by lookarounds, so that matching takes time in proportion to the text; each is
equivalent to the open form in its comment, matched leftmost and without overlaps. Words before and after are read whole,
however long they or the gaps are.

Null and empty texts have no spans. Repeated rows each come out, whatever their ids, and null ids are ids like any other; the
graph counts distinct instances, so repeats change nothing. Spans that start together are listed in the order of their
kinds. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._arrow import named
from millrace.llm._columns import let, sums_before
from millrace.llm._store import forget, stored

#: Kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone", "context")

# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ : a match starts where a run of local characters does, or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
# [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_VALID = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
# [0-9]([\x20-]?[0-9])+ with 14 to 19 digits: whole chains of digits and single separators.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Every match of every pattern has one of these; texts without any are done at a glance.
ANY = "[0-9@]"
#: An instance: what has the form of a phone or card, else a word with a digit or an @.
TOKEN = PHONE + "|" + CARD + r"|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
EDGE = ".,;:!?\"'()[]{}<>*_-#$%&|/\\~`="
#: The white space of the patterns, for functions that split at blanks.
BLANKS = "\t\n\x0b\x0c\r"

#: Least length of an instance; confident instances of a trusted pattern; score to be trusted; a change of score that is none.
LEAST, SUPPORT, CONFIDENT, SETTLED = 5, 3, 0.8, 1e-3


def places(text: Column, pattern: str, use: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """An array with ``use(start, match, gap, next gap)`` of every match: where it starts in code points, and the texts between it and its neighbours."""

    def located(found: Column) -> Column:
        def of(gaps: Column) -> Column:
            sizes = F.zip_with(gaps, found, lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
            return let(sums_before(sizes), lambda at: F.transform(found, lambda m, i: use(F.get(at, i) + F.length(F.get(gaps, i)), m, F.get(gaps, i), F.get(gaps, i + 1))))

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), of))

    return F.when(text.rlike(ANY), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits pass the check: every second one from the right counts twice, less 9 if over 9."""
    value = F.transform(F.split(F.reverse(digits(match)), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda s, x: s + x) % 10 == 0


def valid_phone(match: Column) -> Column:
    return F.length(digits(match)).between(10, 15)


def _spans(text: Column, kind: str, pattern: str, valid: Callable[[Column], Column] | None) -> Column:
    order = KINDS.index(kind)

    def use(start: Column, match: Column, gap: Column, after: Column) -> Column:
        span = F.struct(start.cast("long").alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), (start + F.length(match)).cast("long").alias("end"))
        return F.when(valid(match), span) if valid else span

    return F.coalesce(F.array_compact(places(text, pattern, use)), F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>"))


def base_spans(text: Column) -> Column:
    """The fixed patterns' spans (start, order, kind, end), sorted."""
    return F.array_sort(
        F.concat(
            _spans(text, "email", EMAIL, None),
            _spans(text, "ip", IP, lambda m: m.rlike(IP_VALID)),
            _spans(text, "card", CARD, luhn),
            _spans(text, "phone", PHONE, valid_phone),
        )
    )


def tokens(text: Column) -> Column:
    """The instances (start, end, instance, patterns, seed), in order; instance and patterns as 64-bit hashes."""
    plain = lambda gap: F.btrim(F.translate(gap, BLANKS, " " * len(BLANKS)), F.lit(" "))
    word = lambda gap, side: F.lower(F.btrim(F.substring_index(plain(gap), " ", side), F.lit(EDGE)))

    def use(start: Column, match: Column, gap: Column, after: Column) -> Column:
        core = F.btrim(match, F.lit(EDGE))
        begin = start + F.length(match) - F.length(F.ltrim(match, F.lit(EDGE)))
        seed = core.rlike(EMAIL) | core.rlike(IP_VALID) | (core.rlike("^" + CARD + "$") & luhn(core)) | (match.rlike(PHONE) & valid_phone(match))

        def patterns(words: Column) -> Column:
            left, right = words["left"], words["right"]
            before, behind = left.rlike(r"\p{L}"), right.rlike(r"\p{L}")
            each = F.array(F.when(before, F.xxhash64(F.lit("left"), left)), F.when(behind, F.xxhash64(F.lit("right"), right)), F.when(before & behind, F.xxhash64(F.lit("both"), left, right)))
            return F.array_compact(each)

        def span(found: Column) -> Column:
            kept = F.struct(begin.cast("long").alias("start"), (begin + F.length(core)).cast("long").alias("end"), F.xxhash64(core).alias("instance"), found.alias("patterns"), seed.alias("seed"))
            return F.when(F.length(core) >= LEAST, kept)

        return let(let(F.struct(word(gap, -1).alias("left"), word(after, 1).alias("right")), patterns), span)

    kind = "array<struct<start:bigint,end:bigint,instance:bigint,patterns:array<bigint>,seed:boolean>>"
    return F.coalesce(F.array_compact(places(text, TOKEN, use)), F.array().cast(kind))


def identifiers(occurrences: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """(instance): those that trusted patterns discover, from occurrences (instance, pattern, seed)."""
    edges = stored(occurrences.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "graph")
    score = stored(edges.groupBy("instance").agg(F.max("seed").alias("seed")).withColumn("score", F.col("seed").cast("double")), "scores")
    while True:
        patterns = edges.join(score.select("instance", "score"), "instance").groupBy("pattern").agg(F.count_if(F.col("score") >= confident).alias("sure"), (F.sum("score") / (F.count("*") + 1)).alias("trust"))
        patterns = stored(patterns.filter((F.col("sure") >= support) & (F.col("trust") >= confident)).select("pattern", "trust"), "patterns")
        # A product over patterns as a sum of logarithms; a pattern's score is below 1.
        wrong = stored(edges.filter(~F.col("seed")).join(patterns, "pattern").groupBy("instance").agg(F.exp(F.sum(F.log1p(-F.col("trust")))).alias("wrong")), "wrong")
        again = score.select("instance", "seed", F.col("score").alias("old")).join(wrong, "instance", "left")
        after = stored(again.select("instance", "seed", "old", F.when(F.col("seed"), 1.0).otherwise(1 - F.coalesce("wrong", F.lit(1.0))).alias("score")), "scores")
        risen = after.filter(F.col("score") - F.col("old") > SETTLED).limit(1).count()
        for done in (score, patterns, wrong):
            forget(done)
        score = after
        if not risen:
            forget(edges)
            return stored(score.filter(~F.col("seed") & (F.col("score") >= confident)).select("instance"), "identifiers")


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): every row's spans as an array of (start, order, kind, end), by start, then kind as listed in ``KINDS``."""
    rows = named(docs, key=key, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    found = stored(rows.select(F.monotonically_increasing_id().alias("row"), "key", base_spans(F.col("text")).alias("base"), tokens(F.col("text")).alias("tokens")), "spans")
    each = found.filter(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t")).select("row", "t.*")
    new = identifiers(each.select("instance", F.explode("patterns").alias("pattern"), "seed"))
    span = F.struct("start", F.lit(KINDS.index("context")).alias("order"), F.lit("context").alias("kind"), "end")
    # Rows of an identifier in a third of all texts can be split between tasks: both inputs are plain tables.
    more = stored(each.filter(~F.col("seed")).select("row", "start", "end", "instance").join(new, "instance").groupBy("row").agg(F.collect_list(span).alias("more")), "more")
    both = found.select("row", "key", "base").join(more, "row", "left")
    return both.select("key", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))).alias("spans"))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op3: counts of the fixed kinds, a hash of their spans, and all spans."""
    spans = F.col("spans")
    of = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter(spans, lambda s: s["kind"] != "context")
    return extract(docs).select(F.col("key").alias("doc_id"), of("email"), of("ip"), of("card"), of("phone"), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))


def counts(docs: DataFrame) -> DataFrame:
    """The fixed kinds' counts alone, which SQL can express."""
    return digest(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


COUNTS = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
m AS (SELECT doc_id, regexp_extract_all(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email, regexp_extract_all(x, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ip,
  list_transform(regexp_extract_all(x, '[0-9]([\x20-]?[0-9])+'), lambda m: reverse(regexp_replace(m, '[^0-9]', '', 'g'))) AS card,
  list_transform(regexp_extract_all(x, '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g'))) AS phone FROM t)
SELECT doc_id, CAST(len(email) AS BIGINT) AS n_email,
CAST(len(list_filter(ip, lambda a: len(list_filter(string_split(a, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(p, 3) AS INTEGER) > 255)) = 0)) AS BIGINT) AS n_ip,
CAST(len(list_filter(card, lambda d: length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(length(d)),
  lambda i: CASE WHEN i % 2 = 0 THEN CAST(d[i + 1] AS INTEGER) ELSE CAST(d[i + 1] AS INTEGER) * 2 - CASE WHEN d[i + 1] > '4' THEN 9 ELSE 0 END END)) % 10 = 0)) AS BIGINT) AS n_card,
CAST(len(list_filter(phone, lambda n: n BETWEEN 10 AND 15)) AS BIGINT) AS n_phone
FROM m
"""
