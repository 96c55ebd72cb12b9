"""BPE encoding and decoding with a vocabulary file, unsplit texts by tree concatenation.

A text is cut at ASCII white space, which no token of these vocabularies spans, and each segment is encoded once per
worker while it stays in a bounded cache. A pre-token (what the vocabulary's splits leave whole) of up to ``LEAF`` characters is encoded by the
library. A longer one, from a long word to a text without any break, is split
in halves, down to leaves, which are encoded in parallel threads if there are many; then the halves are joined bottom-up: a window of tokens
around the join is re-encoded, and grows until its first and last token are those that the halves already have there.
Every pair of neighbours in the result then occurs in an encoding of some substring, which makes the whole the
encoding of the concatenation; if a window grows to the whole text, it is that by definition.

Null and empty texts have no tokens. A very long text takes time in proportion. Rows are independent, so repeated rows get the same tokens
and no order or tie matters; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm._arrow import picked, steps, texts

#: Characters of a pre-token that the library encodes in one go; more where a pre-token would have over ``LEAVES`` leaves.
LEAF, LEAVES = 12, 1024
#: Segments that a worker process keeps, and the longest segment kept.
CACHE, CACHED_LENGTH = 250_000, 128
#: Tokens on each side of a join that the first window holds.
WINDOW = 4

Ids = list[int]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tree_concatenate(text: str, inner: Callable[[str], Ids], last: Callable[[str], Ids], spell: Callable[[int], str], leaf: int = LEAF, window: int = WINDOW, pool: ThreadPoolExecutor | None = None) -> Ids:
    """The tokens of one unsplit ``text``.

    ``inner`` encodes a stretch that does not end the text, ``last`` one that does, ``spell`` gives a token's characters
    (without an end-of-word mark). Leaves have ``leaf`` characters at most.
    """
    if len(text) <= leaf:
        return last(text)
    n = 1
    while len(text) > leaf * n:
        n *= 2
    cuts = [len(text) * i // n for i in range(n + 1)]
    stretches = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    run = pool.map if pool else map
    level = [*run(inner, stretches[:-1]), last(stretches[-1])]
    while len(level) > 1:
        pairs = [(level[i], level[i + 1], i + 2 == len(level)) for i in range(0, len(level), 2)]
        level = [join(a, b, last if end else inner, inner, spell, window) for a, b, end in pairs]
    return level[0]


def join(left: Ids, right: Ids, last: Callable[[str], Ids], inner: Callable[[str], Ids], spell: Callable[[int], str], window: int = WINDOW) -> Ids:
    """The tokens of the concatenation of what ``left`` and ``right`` encode; ``last`` encodes stretches that end it."""
    k = window
    while True:
        a, b = min(k, len(left)), min(k, len(right))
        encode = last if b == len(right) else inner
        again = encode("".join(map(spell, left[len(left) - a :])) + "".join(map(spell, right[:b])))
        if (a == len(left) or again[0] == left[len(left) - a]) and (b == len(right) or again[-1] == right[b - 1]):
            return left[: len(left) - a] + again + right[b:]
        k *= 2


class Codec:
    """Encodes and decodes as the library does, with its vocabulary file's normalizer, splits and merges."""

    def __init__(self, file: str, leaf: int = LEAF) -> None:
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.leaf = leaf
        self.whole = Tokenizer.from_file(file)
        self.whole.no_truncation()
        self.whole.no_padding()
        model = json.load(open(file, encoding="utf-8"))["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.open = BPE(model["vocab"], merges)  # no end-of-word mark
        self.shut = BPE(model["vocab"], merges, end_of_word_suffix=self.suffix or None)
        added = self.whole.get_added_tokens_decoder().values()
        # Added tokens stand for themselves wherever they are; with other options than these the library finds them.
        self.apart = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added)
        self.marks = re.compile("(" + "|".join(re.escape(t.content) for t in sorted(added, key=lambda t: -len(t.content))) + ")") if added else re.compile("(?!)()")
        names = self.whole.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.names[i] = name
        self.ends = np.array([bool(self.suffix) and name.endswith(self.suffix) for name in self.names])
        self.pool = ThreadPoolExecutor(2)
        self.kept: dict[bytes, tuple[bytes, str]] = {}

    def spell(self, i: int) -> str:
        name = self.names[i]
        return name.removesuffix(self.suffix) if self.suffix else name

    def inner(self, stretch: str) -> Ids:
        return [t.id for t in self.open.tokenize(stretch)]

    def last(self, stretch: str) -> Ids:
        return [t.id for t in self.shut.tokenize(stretch)]

    def segment(self, text: str) -> Ids:
        """The tokens of a text without ASCII white space."""
        if len(text) <= self.leaf or not self.apart and self.marks.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        out: Ids = []
        for k, part in enumerate(self.marks.split(text)):
            if k % 2:
                out.append(self.whole.token_to_id(part))
                continue
            for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(part)):
                leaf = max(self.leaf, len(piece) // LEAVES)
                out += tree_concatenate(piece, self.inner, self.last, self.spell, leaf, pool=self.pool if len(piece) > 64 * leaf else None)
        return out

    def pack(self, ids: Ids) -> tuple[bytes, str]:
        return np.asarray(ids, "<u4").tobytes(), " ".join([self.names[i] for i in ids])

    def short(self, segments: list[bytes]) -> dict[bytes, tuple[bytes, str]]:
        """Segments packed. Plain words of a leaf's length, with or without a mark at the end, go to the library many at a time.

        A pre-token ends with a token that has the end-of-word mark, and no other token has it, so counting ends tells the
        words' tokens apart: a plain word has one end, its mark another.
        """
        out: dict[bytes, tuple[bytes, str]] = {}
        plain: list[tuple[bytes, str, int]] = []
        for w in segments:
            text = w.decode()
            letters = text.lower()
            body = letters[:-1] if letters[-1] in ".,;:!?" else letters
            if self.suffix and body.isalpha() and len(body) <= self.leaf:
                plain.append((w, text, 1 + (body is not letters)))
            else:
                out[w] = self.pack(self.segment(text))
        for i in range(0, len(plain), 2048):
            part = plain[i : i + 2048]
            ids = self.whole.encode(" ".join([t for _, t, _ in part]), add_special_tokens=False).ids
            packed = np.asarray(ids, "<u4")
            ends = np.flatnonzero(self.ends[packed]) + 1
            counts = np.cumsum([n for _, _, n in part])
            if len(ends) != counts[-1]:  # not as plain as they look
                out |= {w: self.pack(self.whole.encode(t, add_special_tokens=False).ids) for w, t, _ in part}
                continue
            cuts = [0, *ends[counts - 1].tolist()]
            flat, names = packed.tobytes(), [self.names[k] for k in ids]
            for (w, _, _), a, b in zip(part, cuts, cuts[1:], strict=False):
                out[w] = flat[4 * a : 4 * b], " ".join(names[a:b])
        return out

    def rows(self, batch: list[str]) -> list[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and the decoded text."""
        split = [x.encode().split() for x in batch]
        kept = self.kept
        if len(kept) > CACHE:
            kept.clear()
        missing = list({w for words in split for w in words if w not in kept})
        kept.update(self.short([w for w in missing if len(w) <= CACHED_LENGTH]))
        long = {w: self.pack(self.segment(w.decode())) for w in missing if len(w) > CACHED_LENGTH}
        out = []
        for words in split:
            found = [kept[w] if w in kept else long[w] for w in words] if long else [kept[w] for w in words]
            out.append((b"".join([ids for ids, _ in found]), " ".join([s for _, s in found if s])))
        return out


@functools.lru_cache(maxsize=1)
def shared_codec(file: str) -> Codec:
    """One codec for all tasks of a worker process; a task has one core, so the library stays on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Codec(file)


def encode(docs: DataFrame, keep: list[str], text: str = "text", file: str | None = None, ids: bool = True) -> DataFrame:
    """The columns ``keep`` with n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids.

    ``file`` is the vocabulary's path on the executors (default: the public word vocabulary that is installed there).
    Null and empty texts have 0 tokens and the hashes of nothing. Kept columns with the new names give way.
    """
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    new += [T.StructField("token_ids", T.ArrayType(T.IntegerType()))] if ids else []
    keep = [c for c in keep if c not in {f.name for f in new}]
    schema = T.StructType([*(docs.schema[c] for c in keep), *new])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(file or default_vocabulary())
        for batch in steps(batches, text, 1 << 20):
            rows = codec.rows(texts(batch, text))
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            arrays += [pa.array([len(i) // 4 for i, _ in rows], pa.int64())]
            arrays += [pa.array([hashlib.sha256(i).hexdigest() for i, _ in rows], pa.string())]
            arrays += [pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in rows], pa.string())]
            if ids:
                ends = np.cumsum([0, *(len(i) // 4 for i, _ in rows)]).astype(np.int32)
                flat = np.frombuffer(b"".join([i for i, _ in rows]), np.int32)
                arrays += [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(f.name for f in new)])

    return picked(docs, *keep, text).mapInArrow(pass_, schema)


def digest(docs: DataFrame, file: str | None = None) -> DataFrame:
    """The rows of query op6."""
    return encode(docs, ["doc_id"], file=file, ids=False)
