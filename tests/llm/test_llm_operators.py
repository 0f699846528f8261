"""The other operators against brute force, libraries and held-out labels."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsieve.llm import bpe, chat, mixing, sharding, sketch, top_k, toxicity
from postsieve.llm.queries import tokenizer_path
from tests.llm.conftest import make_rows


def n_words(text):
    return len(re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))


def highest_quotients(targets, most, seats):
    out = [0] * len(targets)
    for _ in range(seats):
        best = max((t / (2 * k + 1), -i) for i, (t, k) in enumerate(zip(targets, out, strict=True)) if k < most[i])
        out[-best[1]] += 1
    return out


def test_awards_are_highest_quotients(spark):
    targets, most = [100.0, 37.5, 0.0, 3.2, 61.0, 61.0], [1000, 1000, 5, 2, 20, 1000]
    df = spark.createDataFrame([(i, t, m) for i, (t, m) in enumerate(zip(targets, most, strict=True))],
                               "source_no long, target double, most long")
    quotas = mixing.awards(df, 131, n_shards=4).collect()
    got = Counter()
    for r in quotas:
        got[r["source_no"]] += r["blocks"]
    assert [got[i] for i in range(len(targets))] == highest_quotients(targets, most, 131)
    sizes = Counter()
    for r in quotas:
        sizes[r["shard"]] += r["blocks"]
    assert sorted(sizes) == [0, 1, 2, 3] and max(sizes.values()) - min(sizes.values()) <= 1


def test_mixing(docs, empty):
    rows = make_rows()
    found, mix = mixing.mix_words(docs)
    got = found.collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((r[0], n_words(r[1]), r[3]) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += n_words(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, budget = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        rate = (budget - sum(target.values())) / sum(weight[s] for s in left)
        above = [s for s in left if rate * weight[s] > 2 * sizes[s]]
        if not above:
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left.remove(s)
    target |= {s: rate * weight[s] for s in left}
    taken = Counter()
    for r in got:
        assert r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 2.5 * mix.block
    again, _ = mixing.mix_words(docs.repartition(5))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))

    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += n_words(r["text"])
    assert words == Counter({s: n for s, n in taken.items() if n})
    assert mixing.mix_words(empty)[0].count() == 0 and mixing.mixed_documents(empty).count() == 0
    silent = docs.withColumn("text", F.lit(""))
    assert {(r["target"], r["taken"]) for r in mixing.mix_words(silent)[0].collect()} == {(0.0, 0)}


def test_small_sources_keep_their_share_of_a_large_mix(spark):
    """Blocks do not grow with the corpus, and a source of less than a block has blocks of its size."""
    sizes = {"big": 6_000_000_000, "few": 900, "mid": 3_000, "old": 5, "one": 1, "zero": 0}
    records = spark.createDataFrame(list(sizes.items()), "source string, size long")
    mix = mixing.plan_mix(records, weights=(5, 2, 1))
    rows = {r["source"]: r for r in mix.sources.collect()}
    assert mix.block == 16 and rows["big"]["target"] > 5e9
    for name, size in sizes.items():
        r = rows[name]
        turns, rest = divmod(r["seats"], max(1, r["blocks"]))
        low = turns * size + rest * r["short"]
        assert abs(low - r["target"]) <= 8 + min(rest, r["longer"]), name
    assert rows["mid"]["target"] == 6_000 and rows["mid"]["seats"] == 2 * rows["mid"]["blocks"]
    assert sum(r["blocks"] for r in mix.quotas.collect()) == sum(r["seats"] for r in rows.values())

    text = " ".join(f"w{i}" for i in range(3_000))
    docs = spark.createDataFrame(
        [(1, text, "a"), (2, text, "a"), (3, "three short words", "b"), (4, "x", "c"), (5, text[:700], "d")],
        "doc_id long, text string, source string")
    taken = {r["doc_id"]: r for r in mixing.mix_words(docs)[0].collect()}
    words = Counter()
    for r in mixing.mixed_documents(docs).collect():
        words[r["doc_id"]] += n_words(r["text"])
    assert words == Counter({i: r["taken"] for i, r in taken.items()})
    assert taken[3]["taken"] == 6 and taken[4]["taken"] == 2 and taken[5]["taken"] == 2 * taken[5]["size"]


@pytest.mark.parametrize("seats", [1, 3, 2_000, 40_000, 10**9])
def test_awards_with_many_ties(spark, seats):
    targets, most = [100.0] * 1500 + [50.0, 300.0, 1e-9], [40] * 1500 + [3, 1000, 2]
    df = spark.createDataFrame([(i, t, m) for i, (t, m) in enumerate(zip(targets, most, strict=True))],
                               "source_no long, target double, most long")
    all_ = sorted((-t / (2 * k + 1), i) for i, (t, m) in enumerate(zip(targets, most, strict=True)) for k in range(m))
    seats_, expected = min(seats, len(all_)), Counter()
    for rank, (_, i) in enumerate(all_[:seats_]):
        expected[rank * 4 // seats_, i] += 1
    got = mixing.awards(df, seats, n_shards=4).collect()
    assert Counter({(r["shard"], r["source_no"]): r["blocks"] for r in got}) == expected


def test_bpe_is_the_library(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    expected = Counter()
    for r in make_rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        expected[(r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.digests(docs, tokenizer_path()).collect())) == expected
    assert bpe.encode_documents(empty, tokenizer_path()).count() == 0
    assert set(bpe.encode_documents(docs, tokenizer_path()).columns) == set(docs.columns)


def test_bpe_automaton_on_random_texts():
    import random

    import regex
    from tokenizers import Tokenizer

    machine, library, rnd = bpe.compiled(tokenizer_path()), Tokenizer.from_file(tokenizer_path()), random.Random(3)
    letters = "  aaeehtts ningroABC0123'\n\t\r\x0b\x1c\x85\xa0 éßñ漢😀²-_=.,!?"
    plain, fast = re.compile(bpe._PLAIN).fullmatch, re.compile(bpe._PLAIN_PATTERN).findall
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50)))
        words = regex.findall(bpe.PATTERN, text)
        if plain(text):
            assert fast(text) == words
        ids = [i for w in words for i in machine.read(w.encode())]
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_chats(spark):
    rows = [(1, 0, "user", "a ### b \\h </turn> \\"), (1, 1, "assistant", "x</turn>\ny"), (2, 1, "assistant", None),
            (2, 0, "user", ""), (3, 0, None, "t"), (3, 0, "odd: role###", None), (None, 5, "user", "q"),
            (4, None, "user", "n"), (4, 2, "assistant", "m"), (5, 0, "user", "u"), (5, 0, "user", "u"),
            (6, 0, "user", "u"), (6, 1, "assistant", "long " * 50_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "conv_id long, turn long, role string, text string, formatted string")
    template = chat.Template()
    made = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chats(df)).collect()}
    groups = defaultdict(list)
    for c, turn, role, text in rows:
        groups[c].append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        assert template.turns(made[c]["formatted"]) == [(r, t) for _, r, t in turns]
        said = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[c]["loss_chars"] == len(said)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert got[c]["formatted_chars"] == len(made[c]["formatted"]) and got[c]["n_turns"] == len(turns)
    assert {c for c in got if got[c]["valid"]} == {1, 2, 4, 6}
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chats_of_any_length_stay_rows(spark, tmp_path):
    """The query collects no conversation into one value, and gives what assembled conversations give."""
    from postsieve.llm.queries import QUERIES

    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} ### \\ </turn> " + "é" * t) for t in range(700)]
    rows += [(None, t, "user", "q") for t in range(40)] + [(2, 0, "user", None), (2, 1, "assistant", "a"), (3, 0, None, "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    found = QUERIES["op4_chat_formatting"](spark, str(tmp_path))
    assert "collect_list" not in found._jdf.queryExecution().toString()
    expected = Counter(map(tuple, chat.digests(chat.format_chats(df)).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert Counter(map(tuple, chat.stream_digests(df).collect())) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Counter(tuple(r) for r in found.collect() if r["conv_id"] != -7) == expected
    assert chat.stream_digests(df.limit(0)).count() == 0


def test_sketches(docs, empty):
    rows = sorted(make_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sketch.edited_by_neighbour(docs).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((r[0], len(r[1] or "")) for r in rows)
    unique = [i for i, r in enumerate(rows) if sum(r[0] == x[0] for x in rows) == 1]
    by_key = {r["doc_id"]: r for r in got}
    for i in unique:
        if i + 1 not in unique and i + 1 < len(rows):
            continue
        text, after = rows[i][1] or "", rows[(i + 1) % len(rows)][1] or ""
        if i + 1 == len(rows):
            continue  # the first rows share a null key
        tail = len(text) // 4
        edited = text[:len(text) - tail] + after[:tail]
        row = by_key[rows[i][0]]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, other = sketch.sketch(text.encode()), sketch.sketch(edited.encode())
        assert row["fingerprint"] == sketch.written(own) and (sketch.read(row["fingerprint"]) == own).all()
        assert row["near_edited"] == sketch.containment(own, other) and 0 <= row["near_next"] <= 1
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (1, 2, -3)}) == 1
    assert sketch.edited_by_neighbour(empty).count() == 0
    assert sketch.with_sketch(docs).count() == len(rows)


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in rng.integers(0, 1 << 40, 40_000)]
    whole, part = " ".join(words).encode(), " ".join(words[5_000:9_000]).encode()
    a, b = sketch.sketch(whole), sketch.sketch(part)
    assert sketch.containment(a, b) > 0.98
    half = sketch.merge(sketch.sketch(" ".join(words[:20_000]).encode()), sketch.sketch(" ".join(words[19_996:]).encode()))
    assert (half == a).all()


def test_likeness_against_all_shingles(spark):
    """With every hash kept: the containment of word tuples, the pair of last and first document included."""
    def tuples(text):
        words = text.encode("utf-8", "surrogatepass").split()
        width = min(5, len(words))
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()

    def likeness(a, b):
        return float(len(a) == len(b)) if not a or not b else len(a & b) / min(len(a), len(b))

    rows = {r[0]: r[1] or "" for r in make_rows() if r[0] is not None}
    keys = sorted(rows)
    expected = {}
    for i, key in enumerate(keys):
        own, following = rows[key], rows[keys[(i + 1) % len(keys)]]
        tail = len(own) // 4
        edited = own[:len(own) - tail] + following[:tail]
        expected[key] = (likeness(tuples(own), tuples(edited)), likeness(tuples(own), tuples(following)))
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["near_edited"], r["near_next"]) for r in sketch.edited_by_neighbour(df, scale=1).collect()}
    assert got == expected and 0 < got[keys[-1]][0] <= 1
    # the kept half of the hashes comes close to that
    half = {r["doc_id"]: r["near_edited"] for r in sketch.edited_by_neighbour(df).collect()}
    assert np.mean([abs(half[k] - expected[k][0]) for k in keys]) < 0.15


def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(900)]
    rows += [(20, rows[20][1]), (None, rows[3][1]), (1000, None), (1020, [1.0, None, 0.0]),
             (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (1080, [1.0, 2.0]), (1101, [3.0, -1.0]), (1120, [])]
    rows += [(2000 + i, rows[40][1]) for i in range(50)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, score string")
    ints = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = Counter()
    for n, (i, v) in enumerate(ints):
        if i is None or i % 20:
            continue
        scored = sorted((-int(v @ w), j is None, j or 0, m) for m, (j, w) in enumerate(ints) if m != n and len(w) == len(v))
        for rank, (s, none, j, _) in enumerate(scored[:20], 1):
            expected[(i, rank, None if none else j, -s)] += 1
    found = top_k.top_k(df, k=20, divisor=20)
    assert Counter(map(tuple, found.collect())) == expected
    assert top_k.top_k(df.limit(0), k=20, divisor=20).count() == 0


def test_top_k_prunes_blocks_and_chunks(monkeypatch):
    """Coherent blocks in three chunks: later chunks are pruned by the scores of earlier ones."""
    from postsieve.llm.grid import pack_of

    monkeypatch.setattr(top_k, "BLOCK_ROWS", 256)

    rng = np.random.default_rng(4)
    centre = np.repeat(rng.integers(-60, 60, (48, 8)), 256, 0)
    rows = centre + rng.integers(-3, 4, centre.shape)
    q = rows[::200]
    search, shares = top_k.Search(pack_of(99, np.arange(len(q)), q), 5), []
    for chunk in range(3):
        before = search.scored, search.possible
        part = rows[chunk * 4096:(chunk + 1) * 4096]
        search.feed(pack_of(chunk, np.arange(len(part)) + chunk * 4096, part))
        shares.append((search.scored - before[0]) / (search.possible - before[1]))
    print("share of blocks scored by chunk", shares)
    assert shares[0] < 0.6 and shares[2] < 0.5 * shares[0]
    exact = np.sort(q @ rows.T, 1)[:, ::-1][:, :5]
    assert (search.best.rows[1].reshape(len(q), 5) == exact).all()


def test_products_beyond_doubles():
    big = np.array([[2**40, 1]]), np.array([[2**20, 3], [2**40, 0]])
    assert top_k._products(*big).tolist() == [[2**60 + 3, np.iinfo(np.int64).max]]


def test_toxicity(spark, docs, empty):
    import random

    rnd = random.Random(8)
    words = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 7))) for _ in range(800)]
    bad = ["vexwort", "quxmug", "zebkog"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        text = [rnd.choice(words) for _ in range(rnd.randint(30, 90))]
        if toxic:
            for _ in range(4):
                text[rnd.randrange(len(text))] = rnd.choice(bad)
        rows.append((i, " ".join(text), "clash"))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (3, None), (5000, 1)]
    df = spark.createDataFrame([*rows, (None, None, ""), (None, "", ""), (901, "x" * 300_000, ""), rows[0]],
                               "doc_id long, text string, score string")
    told = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.with_toxicity(df, told).collect()
    assert len(got) == len(rows) + 4
    held = [r for r in got if r["held_out"]]
    assert 200 < len(held) < 400
    assert sum((r["doc_id"] % 4 == 0) == bool(r["predicted"]) for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert not any(r["predicted"] for r in got if r["doc_id"] in (None, 901))
    kept = toxicity.without_toxic(df, told)
    assert kept.columns == df.columns and kept.count() == sum(1 - r["predicted"] for r in got)
    assert toxicity.with_toxicity(empty, told).count() == 0
    assert {r["score"] for r in toxicity.with_toxicity(docs, told.limit(0)).collect()} == {0.0}


def test_shards(docs, empty):
    import zlib

    placed, maps = sharding.shard_documents(docs, n_shards=5, n_slots=256)
    got = placed.collect()
    rows = make_rows()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r)
    for members in by_shard.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    assert all(r["next_shard"] in (r["shard"], 5) for r in got)
    versions = defaultdict(dict)
    for r in maps.collect():
        versions[r["version"]][r["slot"]] = r["shard"]
    assert {v: len(m) for v, m in versions.items()} == {1: 256, 2: 256}
    assert all(versions[2][s] in (shard, 5) for s, shard in versions[1].items())
    assert sharding.shard_documents(empty, n_shards=3)[0].count() == 0


def test_shards_near_equal_and_stored(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    placed, maps = sharding.shard_documents(df, n_shards=7)
    sums = [r[1] for r in placed.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sums) == 7 and max(sums) - min(sums) < 0.01 * sum(sums) / 7
    grown = [r[1] for r in placed.groupBy("next_shard").agg(F.sum("size")).collect()]
    assert len(grown) == 8 and max(grown) < 1.1 * sum(sums) / 8
    path = str(tmp_path / "map")
    for v in (1, 2):
        sharding.save_map(maps.filter(F.col("version") == v), path)
    newest = sharding.load_map(spark, path)
    assert newest.count() == sharding.N_SLOTS and newest.first()["version"] == 2
    records = df.withColumn("virtual_slot", sharding.virtual_slot(F.col("doc_id"), F.crc32("text")))
    out = str(tmp_path / "shards")
    sharding.write_shards(records, sharding.load_map(spark, path, 1), out)
    assert spark.read.parquet(out).count() == 5000
