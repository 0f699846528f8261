"""Every stage on documents with nulls, repeats and clashing columns, against brute force."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from postsieve.llm import simhash
from postsieve.llm.base import staged
from postsieve.llm.queries import tokenizer_path
from tests.llm.conftest import make_rows
from tests.llm.test_dedup import brute_bytes
from tests.llm.test_llm_operators import n_words


def test_stages(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    told = [(i, int(i % 7 == 0)) for i in range(20, 60)] + [(None, 1), (4, None)]
    spark.createDataFrame(told, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash_near_dedup", "suffix_array_dedup", "mixing", "bpe"]

    def run(name, df):
        return staged(stages[name](spark, df, str(tmp_path)), name)

    clean = run("toxicity", docs)
    assert clean.columns == docs.columns
    left = Counter((r["doc_id"], r["text"]) for r in clean.collect())
    assert not left - Counter((r[0], r[1]) for r in make_rows())

    unique = run("simhash_near_dedup", clean)
    assert unique.columns == docs.columns
    prints = {k: simhash.simhash((k[1] or "").encode(), 4) for k in left}
    root = {f: f for f in prints.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in list(root):
        for b in list(root):
            if a != b and (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    groups = {}
    for (key, _), f in prints.items():
        rank = (key is None, key or 0)
        groups[find(f)] = min(groups.get(find(f), rank), rank)
    rows = [(r["doc_id"], r["text"]) for r in unique.collect()]
    assert Counter((k is None, k or 0) for k, _ in rows) == Counter(groups.values())

    cut = run("suffix_array_dedup", unique)
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r for r in cut.collect()}
    for row, (_, removed, _, _) in zip(rows, brute_bytes(rows, corpus_pipeline.REPEAT), strict=True):
        if rows.count(row) == 1 and sum(k == row[0] for k, _ in rows) == 1:
            got = texts[row[0]]["text"]
            assert (got == row[1]) if not removed else len(got.encode()) <= len(row[1].encode())
            assert texts[row[0]]["n_chars"] == len(got or "")

    mixed = run("mixing", cut)
    assert mixed.columns == docs.columns
    before, after = Counter(), Counter()
    for r in cut.collect():
        before[r["source"]] += n_words(r["text"])
    for r in mixed.collect():
        after[r["source"]] += n_words(r["text"])
    assert all(after[s] <= 2 * n for s, n in before.items())
    assert abs(sum(after.values()) - 1.5 * sum(before.values())) <= 40 * len(before)

    coded = run("bpe", mixed).collect()
    library = Tokenizer.from_file(tokenizer_path())
    expected = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids))
                       for r in mixed.collect())
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in coded) == expected
    assert all(r["round_trip"] for r in coded)


def test_stages_on_nothing(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), str(tmp_path))
        assert out.count() == 0, name
        if name != "bpe":
            assert out.columns == docs.columns
    nulls = docs.limit(2).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nulls, str(tmp_path)).count() <= 2
