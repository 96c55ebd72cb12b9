from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from millrace.llm import bpe, decontaminate, quality, secrets
from millrace.llm.queries import table
from test_similar import plain_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes in and comes out of every stage."""
    docs = table(spark, SF, "documents")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = table(spark, SF, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    for name, (before, after) in stages.items():
        assert before.columns == columns
        assert after.columns == columns or name == "tokens"


def test_quality(spark, stages):
    before, after = map(rows, stages["quality"])
    fitted = quality.fit(quality.featured(table(spark, SF, "documents")), table(spark, SF, "labels"))
    scores = fitted.score(np.array([quality.statistics(r.text) for r in before.values()]))
    assert set(after) == {k for k, s in zip(before, scores, strict=True) if s >= 0.5}
    labels = rows(table(spark, SF, "labels"))
    assert all(k in after for k, r in labels.items() if r.quality)
    assert not any(k in after for k, r in labels.items() if not r.quality)


def test_near_duplicates(stages):
    before, after = map(rows, stages["near_duplicates"])
    ids = sorted(before)
    roots = plain_components([before[i].text for i in ids])
    assert sorted(after) == [k for i, k in enumerate(ids) if roots[i] == i]
    assert all(after[i] == before[i] for i in after)


def test_decontamination(spark, stages):
    before, after = map(rows, stages["decontamination"])
    taken = {tuple(w[i : i + min(10, len(w))]) for r in table(spark, SF, "benchmark").collect() for w in [decontaminate.words(r.text)] for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(t) for t in taken}
    dirty = {k for k, r in before.items() for w in [decontaminate.words(r.text)] for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in taken}
    assert dirty and set(after) == set(before) - dirty


def test_secrets(stages):
    before, after = map(rows, stages["secrets"])
    assert set(before) == set(after)
    changed = {k for k in before if before[k] != after[k]}
    assert changed == {k for k, r in before.items() if secrets.find(r.text)}
    for r in after.values():
        assert not secrets.find(r.text)
        assert r.n_chars == len(r.text)


def test_tokens(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    before, after = map(rows, stages["tokens"])
    assert set(before) == set(after)
    for k, r in after.items():
        ids = library.encode(before[k].text, add_special_tokens=False).ids
        assert (r.token_ids, r.n_tokens, r.ids_sha256) == (ids, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())


def test_run_does_all_stages(spark, stages):
    got = rows(corpus_pipeline.run(spark, SF))
    assert got == rows(stages["tokens"][1])


def odd_folder(tmp_path, docs):
    """A folder of tables whose documents have missing and repeated ids and columns with names that the stages use themselves."""
    clash = ["row", "key", "component", "text__", "n_words", "place", "batch", "quality"]
    cols = {"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string()), "lang": pa.nulls(len(docs), pa.string()), "source": pa.nulls(len(docs), pa.string()), "n_chars": pa.array([None if t is None else len(t) for _, t in docs], pa.int64())}
    pq.write_table(pa.table(cols | {c: pa.array([f"{c}{i}" for i in range(len(docs))], pa.string()) for c in clash}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([], pa.int64()), "quality": pa.array([], pa.int32()), "toxic": pa.array([], pa.int32())}), tmp_path / "labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1, None], pa.int64()), "text": pa.array(["ten words of a passage that nobody should train on here", None])}), tmp_path / "benchmark.parquet")
    return str(tmp_path)


def test_odd_rows(spark, tmp_path):
    from tokenizers import Tokenizer

    same, other = "one text that stands here more than once with many words", "quite another text with words of its own making and no copy"
    docs = [(5, same), (5, other), (None, same), (3, same.upper()), (None, None), (7, ""), (7, " "), (8, "so TEN words of a passage, that nobody should train on here!"), (9, "token = abcdef123456 " + "long " * 30_000), (None, "alone")]
    sf = odd_folder(tmp_path, docs)
    table_ = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, table_, sf)
        assert after.columns == table_.columns, name
    texts = [t for _, t in docs]
    groups = {}
    for i, r in enumerate(plain_components(texts)):
        groups.setdefault(r, []).append(i)
    first = [min(g, key=lambda i: (docs[i][0] is None, docs[i][0] or 0)) for g in groups.values()]
    stays = [i for i in first if docs[i][0] != 8]
    library = Tokenizer.from_file(bpe.default_vocabulary())
    want = sorted((docs[i][0] or 0, library.encode((texts[i] or "").replace("token = abcdef123456", "[SECRET]"), add_special_tokens=False).ids) for i in stays)
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id or 0, r.token_ids) for r in got) == want


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, odd_folder(tmp_path, [])).collect() == []
