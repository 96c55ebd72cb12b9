"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a maximal run of token characters. A window of ``WINDOW`` characters slides over it; its entropy follows
from the sum of ``c * log2(c)`` over the character counts, which changes by two terms when the window moves by one. The
threshold depends on the candidate's character class (hex, alphanumeric, base64). Windows at or over it are united to
spans of kind ``entropy``. An allow-list suppresses candidates that are harmless by form. Nothing else does: an entropy span is
reported whether or not a pattern's span covers it too, and redaction unites what overlaps.

Null and empty texts have no spans. A very long text or candidate takes time in proportion to its length. Spans that start
together are listed in the order of their kinds. Rows are independent, so repeated rows each get the same spans; an empty table gives an
empty result; other columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._arrow import picked, steps, texts
from millrace.llm._ship import ship

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run of 20 or 24 characters or more matches the same spans as the open pattern with short matches dropped: what a
# short match takes up holds no longer one.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Characters in a window, and the least entropy in bits by class; 24 random characters have about 3.4 (hex) and 4.3.
WINDOW = 24
LEAST_BITS = {"hex": 3.0, "alnum": 3.9, "base64": 4.0}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}+" % WINDOW)
CLASSES = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+")),
    ("alnum", re.compile(r"[A-Za-z0-9]+")),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+")),
)
#: Harmless forms: no digit or no letter, UUIDs, runs of one separator, words or numbers joined by separators.
ALLOWED = re.compile(
    r"[^0-9]*|[^A-Za-z]*|(?:[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12})"
    r"|(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))*[+/_=-]*"
)

SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def entropy_spans(run: str, window: int, least: float) -> list[tuple[int, int]]:
    """Unions of the windows of ``run`` with at least ``least`` bits a character, by counts kept while the window moves."""
    if len(run) < window:
        return []
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    most = (math.log2(window) - least) * window + 1e-9
    counts: dict[str, int] = {}
    total = 0.0
    found: list[tuple[int, int]] = []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        total += weight[c + 1] - weight[c]
        counts[ch] = c + 1
        if i >= window:
            old = run[i - window]
            c = counts[old]
            total += weight[c - 1] - weight[c]
            counts[old] = c - 1
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return spans + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def find(text: str) -> list[tuple[int, int, str]]:
    """All spans ``(start, end, kind)`` in code points, by start, then kind as listed in ``KINDS``."""
    spans = base_spans(text)
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if ALLOWED.fullmatch(run):
            continue
        kind = next(k for k, form in CLASSES if form.fullmatch(run))
        for a, b in entropy_spans(run, WINDOW, LEAST_BITS[kind]):
            spans.append((a + m.start(), b + m.start(), "entropy"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, keep: list[str], text: str = "text", out: str = "secret_spans") -> DataFrame:
    """The columns ``keep`` and ``out``: an array of (kind, start, end) for every row's whole text.

    Null and empty texts get an empty array. A kept column named ``out`` gives way to the new one.
    """
    keep = [c for c in keep if c != out]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(out, SPAN)])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in steps(batches, text):
            rows = [[{"kind": k, "start": a, "end": b} for a, b, k in find(x)] for x in texts(batch, text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(rows, kind)], names=[*keep, out])

    return picked(docs, *keep, text).mapInArrow(pass_, schema)


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones united) replaced by ``mark``, and ``n_chars`` counted anew where text changed.

    Rows without a span come out as they went in, null texts included.
    """
    ship(docs.sparkSession)

    def clean(x: str) -> str:
        parts, at = [], 0
        for a, b, _ in find(x):
            if a >= at:
                parts += [x[at:a], mark]
            at = max(at, b)
        return "".join([*parts, x[at:]])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            k = batch.schema.get_field_index(text)
            old = batch.column(k).to_pylist()
            new = [x and clean(x) for x in old]
            arrays = list(batch.columns)
            arrays[k] = pa.array(new, batch.schema.field(k).type)
            if (c := batch.schema.get_field_index(n_chars)) >= 0:
                arrays[c] = pa.array([n if y == x else len(y) for x, y, n in zip(old, new, arrays[c].to_pylist(), strict=True)], arrays[c].type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(pass_, docs.schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op1: counts of the fixed kinds, a hash of their spans, and all spans."""
    spans = F.col("secret_spans")
    of = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter(spans, lambda s: s["kind"] != "entropy")
    return scan(docs, ["doc_id"]).select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))


def counts(docs: DataFrame) -> DataFrame:
    """The fixed kinds' counts alone, which SQL can express."""
    return digest(docs).select("doc_id", "n_assign", "n_access", "n_hex")


#: The patterns in SQL have no marks of possession, and take the key words' letters from the pattern above.
COUNTS = f"""
SELECT doc_id,
CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '{ASSIGN.pattern.replace("'", "''")}', 2), lambda x: length(x) >= 6)) AS BIGINT) AS n_assign,
CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS BIGINT) AS n_access,
CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24)) AS BIGINT) AS n_hex
FROM documents
"""
