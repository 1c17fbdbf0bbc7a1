"""The operators on documents: odd rows, brute force, round trips."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sparrowmill.llm import exact_dedup, language_id, line_dedup, mixing, ngram_join, piece_bpe, ppm, sharding, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, lang string, source string, score double, size string, slot int, _hash string"
LONG = " ".join(f"word{i % 977} of" for i in range(30_000))


def odd_rows():
    """Nulls in every column, empty and very long texts, equal texts, near copies, repeated rows."""
    base = " ".join(f"tok{i}" for i in range(60))
    near = base.replace("tok30", "other")
    texts = [None, "", "  \t\n ", "one", "One", "a b c", base, base + " ", near, base.upper(), LONG, LONG + " end", "É ß 😀 ▁x", "x\n\ny  z"]
    rows = [(i, t, "en" if i % 2 else None, ["s", None, "é"][i % 3], 1.0, "x", 1, "h") for i, t in enumerate(texts)]
    return rows + [rows[6], rows[3], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact_dedup(odd, empty):
    got = exact_dedup.exact_dedup(odd, share=0.2).collect()
    groups = defaultdict(list)
    for r in odd_rows():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sorted(map(repr, exact_dedup.exact_dedup(odd).collect())) == sorted(map(repr, got))
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_heavy_digests_are_found(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_dedup(df, share=1 / 64)
    assert got.filter("kept").count() == 5000 - 1667 + 1
    assert got.filter("group_size = 1667").count() == 1667


def test_sharding(odd, empty):
    got = sharding.shard_documents(odd, shards=3).collect()
    rows = odd_rows()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.doc_id in (3, 4)}) <= 2
    assert sharding.shard_documents(empty).count() == 0


def test_sharding_is_even_with_a_hot_group(spark):
    df = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the hot text")).otherwise(F.repeat(F.lit("w "), (F.col("id") % 50).cast("int"))).alias("text"),
    )
    got = sharding.shard_documents(df).groupBy("shard").agg(F.sum("size"), F.count("*")).collect()
    for i, most in ((1, 1.15), (2, 1.5)):
        values = [r[i] for r in got]
        assert len(values) == 8 and max(values) <= most * min(values)


def test_placing_uses_the_largest_dot_product():
    placed = sharding.place(np.array([[10, 0, 1], [0, 10, 1], [10, 0, 1], [0, 10, 1]], dtype=float), 2)
    assert placed[0] != placed[2] and placed[1] != placed[3]


def test_mixing(odd, empty):
    got = mixing.mix_sources(odd, F.size(F.split("text", " ")), F.lit(None).cast("double")).collect()
    assert len(got) == len(odd_rows())
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        by[r.source].append(r)
    total = sum(r.size for r in got)
    assert math.isclose(sum(rs[0].target for rs in by.values()), total)
    again = mixing.mix_sources(odd.repartition(2), F.size(F.split("text", " ")), F.lit(None).cast("double")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.mix_sources(empty, F.lit(1), F.lit(1.0)).count() == 0


@pytest.mark.parametrize("share,rest", [(0.3, 0.5), (0.3, 0.25), (0.6, 0.25)])
def test_mixing_passes_over_a_very_long_document(spark, share, rest):
    """One document holds a large share of its source; the source still meets its target within a small document."""
    long = round(1000 * share / (1 - share))
    rows = [(i, "a", 1) for i in range(1000)] + [(1000, "a", long), (1001, "b", round((1000 + long) * (8 * rest - 1)))]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint").repartition(4)
    for seed in range(2):
        got = mixing.mix_sources(df, F.col("n"), F.lit(1.0), ratios=(1.0, 7.0), seed=seed).filter("source = 'a'")
        row = got.agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).first()
        assert abs(row.taken - row.target) <= 1 and row.most <= 3


def test_mixing_is_the_greedy_pass_along_the_keys(spark):
    rng = random.Random(11)
    rows = [(i, "ab"[i % 2], rng.choice([0, 1, 2, 3, 50, 400, 3000])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint").repartition(5)
    got = mixing.mix_sources(df, F.col("n"), F.lit(1.0), blocks=4).collect()
    key = lambda i: -math.log((int(hashlib.md5(f"{i}:17".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52)
    for source in "ab":
        mine = sorted((r for r in got if r.source == source), key=lambda r: (key(r.doc_id), r.doc_id))
        whole = math.floor(mine[0].target / mine[0].source_size)
        left, want = mine[0].target - whole * mine[0].source_size, {}
        for r in mine:
            want[r.doc_id] = whole + int(r.size <= left and left > 0)
            left -= r.size * (want[r.doc_id] - whole)
        best = min(((abs(left - r.size), key(r.doc_id), r.doc_id) for r in mine if want[r.doc_id] == whole and abs(left - r.size) < left), default=None)
        if best:
            want[best[2]] += 1
        assert {r.doc_id: r.copies for r in mine} == want


def test_mixing_takes_few_jobs(spark):
    """Each job costs the driver memory: the rounds along the keys are few, also if many documents are passed over."""
    rng = random.Random(12)
    rows = [(i, "abc"[i % 3], rng.choice([0, 1, 2, 5, 20, 70, 300, 900, 3000])) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint")
    spark.sparkContext.setJobGroup("mix", "mix")
    try:
        mixing.mix_sources(df, F.col("n"), F.lit(1.0)).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("mix")) <= 65


@pytest.mark.parametrize("ahead", [1, 7])
def test_mixing_does_not_depend_on_the_look_ahead(spark, monkeypatch, ahead):
    rng = random.Random(13)
    rows = [(rng.choice([None, i, i // 3]), "ab"[i % 2], rng.choice([0, 1, 2, 5, 20, 70, 300, 900])) for i in range(200)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row bigint, doc_id bigint, source string, n bigint")
    mixed = lambda: {r.row: r.copies for r in mixing.mix_sources(df, F.col("n"), F.lit(1.0), blocks=8, row="row").collect()}
    want = mixed()
    monkeypatch.setattr(mixing, "LOOK_AHEAD", ahead)
    assert mixed() == want
    assert len(set(want.values())) > 1


def test_mixing_meets_targets_and_prefers_heavy_weights(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 4000, "big").when(F.col("id") < 5900, "mid").otherwise("small").alias("source"),
        (F.col("id") % 40 + 1).alias("n"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("w"),
    )
    got = mixing.mix_sources(df, F.col("n"), F.col("w")).cache()
    for r in got.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k"), F.first("source_size").alias("s")).collect():
        assert abs(r.k - r.t) <= 40 and r.t <= 3 * r.s + 1e-6
    big = got.filter("source = 'big'").groupBy(F.col("doc_id") % 2).agg(F.sum("copies")).orderBy(F.col("(doc_id % 2)")).collect()
    assert big[0][1] > 1.5 * big[1][1]


def test_pieces_equal_the_library(odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = piece_bpe.encode_documents(odd, MODEL, full=True).collect()
    want = []
    for i, t, *_ in odd_rows():
        ids = library.encode(t or "", add_eos=True)
        text = " ".join(map(str, ids)).encode()
        want.append((i, len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, [tuple(r)[:4] for r in got])) == sorted(map(repr, want))
    for r in got:
        assert library.decode(list(r.ids)) == r.decoded
    assert piece_bpe.encode_documents(empty, MODEL).count() == 0


def test_pieces_of_random_texts():
    with open(MODEL, "rb") as f:
        bpe = piece_bpe.PieceBpe(f.read())
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("ab  ▁\n\tthe é😀x.,0²'_-(\0") for _ in range(rng.randint(0, 40)))
        parts = bpe.encode_batch([text])[0]
        ids = bpe.library.encode(text, add_eos=True)
        assert list(map(int, " ".join(parts).split())) == ids
        assert bpe.decode(parts) == bpe.library.decode(ids)
    for size in (1, 24, 25, 400):
        word = [rng.choice("therandioust") for _ in range(size)]
        assert [p for p in bpe._merge_long(list(word)) if p] == bpe._merge_short(list(word))


def test_language_id(odd, empty, spark):
    got = {r.doc_id: r for r in language_id.identify(odd, F.lit(True)).collect()}
    assert got[1].lang_pred == "und" and got[0].score == 0 and got[2].lang_pred == "und"
    assert got[10].lang_pred == "en" and 0 <= got[10].score <= 1
    nothing = language_id.identify(odd, F.lit(False)).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(odd_rows())
    assert language_id.identify(empty, F.lit(True)).count() == 0


def test_language_id_is_naive_bayes(spark):
    docs = [(0, "abc cab", "x"), (1, "bca", "x"), (2, "xyz zyx", "y")]
    df = spark.createDataFrame(docs, "doc_id int, text string, lang string")
    buckets, lengths = 64, (1, 2)
    counts = {"x": Counter(), "y": Counter()}
    for _, t, lang in docs:
        for bucket, used in language_id.grams([t], lengths, buckets)[3]:
            counts[lang].update(bucket[used].tolist())
    for text in ("abz", "zzz", "cab"):
        logs = []
        for lang, prior in (("x", 2 / 3), ("y", 1 / 3)):
            total = sum(counts[lang].values()) + 0.5 * buckets
            found = [b for bucket, used in language_id.grams([text], lengths, buckets)[3] for b in bucket[used].tolist()]
            logs.append(math.log(prior) + sum(math.log((counts[lang][b] + 0.5) / total) for b in found))
        want = 1 / sum(math.exp(v - max(logs)) for v in logs)
        one = spark.createDataFrame([(9, text, None)], df.schema)
        r = [r for r in language_id.identify(df.union(one), F.lit(True), buckets=buckets, lengths=lengths).collect() if r.doc_id == 9][0]
        assert r.lang_pred == "xy"[int(np.argmax(logs))] and math.isclose(r.score, want, rel_tol=1e-4)


def test_toxicity(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score_toxicity(odd, none).count() == len(odd_rows())
    labels = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(None, 1), (3, None), (99, 1)], "doc_id bigint, toxic int")
    got = toxicity.score_toxicity(odd, labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert toxicity.without_toxic(odd, labels).columns == odd.columns


def test_toxicity_learns_pairs():
    """An insult or a group alone is clean, both together are not: no additive weights can say so."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.array(sorted({*(rng.integers(10, 400, 12)), *([1] if insult else []), *([2] if group else [])})))
        labels.append(float(insult and group))
    machine = toxicity.fit(rows[:2400], np.array(labels[:2400]), buckets=400)
    flat, sizes = np.concatenate(rows[2400:]), np.array([len(r) for r in rows[2400:]])
    right = (machine.score(flat, np.cumsum(sizes) - sizes) >= 0.5) == np.array(labels[2400:])
    assert right.mean() > 0.97
    pair = float(machine.factor[1] @ machine.factor[2])
    assert pair > 0.5


def test_toxicity_learns_a_term_that_tells_only_in_pairs():
    """A frequent group mention without a signal of its own; the insult is toxic only next to it."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(6000):
        insult, group, other = rng.random() < 0.02, rng.random() < 0.31, rng.random() < 0.1
        rows.append(np.array(sorted({*(rng.integers(10, 400, 12)), *[t for t, there in ((1, insult), (2, group), (3, other)) if there]})))
        labels.append(float(other or (insult and group)))
    labels = np.array(labels)
    met = np.array([2 in r for r in rows])
    chance = met.sum() * labels.mean()
    assert abs(labels[met].sum() - chance) < toxicity.DEVIATION * math.sqrt(chance * (1 - labels.mean()) * (1 - met.mean()))
    machine = toxicity.fit(rows, labels, buckets=400)
    assert float(machine.factor[1] @ machine.factor[2]) > 0.5
    pair, insult, group = (float(machine.score(np.array(t), np.array([0]))[0]) for t in ([1, 2], [1], [2]))
    assert pair > 0.5 > insult and group < 0.5


def brute_components(rows, width=5):
    sets = {}
    for i, t, *_ in rows:
        w = [x.decode() for x in (t or "").encode().lower().split()]
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i) if i is not None else None) for i in sets}


def test_ngram_components(odd, empty, monkeypatch):
    monkeypatch.setattr(ngram_join, "FRAGMENTS", 3)
    got = ngram_join.ngram_components(odd).collect()
    want = brute_components(odd_rows()[:-2])
    assert len(got) == len(odd_rows())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    assert ngram_join.ngram_components(empty).count() == 0


def test_ngram_components_of_a_large_near_group(spark, monkeypatch):
    """Many near copies, some linked only through others, and a passage that many texts share."""
    monkeypatch.setattr(ngram_join, "FRAGMENTS", 4)
    rng = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for i in range(150, 220):
        rows.append((i, " ".join(base[:60] + [f"u{i}_{k}" for k in range(rng.choice([5, 20, 60]))])))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_components(rows)


def test_sets_that_share_too_little_do_not_meet_at_every_ngram(spark):
    """40 sets of 100 whose 88 common n-grams do not link them, one copy of each with a difference that does."""
    rng = random.Random(3)
    sets = {}
    for i in range(40):
        own = sorted(rng.sample(range(10**6), 12))
        sets[2 * i] = own + list(range(10**7, 10**7 + 88))
        sets[2 * i + 1] = sets[2 * i][:-1] + [10**8 + i]
    rows = [(n, 100, g, ngram_join.parity(np.array(g, dtype=np.uint64)).tolist()) for n, g in sets.items()]
    nodes = spark.createDataFrame(rows, "node bigint, size int, grams array<bigint>, parity array<bigint>")
    first = nodes.select("node", "size", F.posexplode(F.slice("grams", 1, 21)).alias("pos", "gram"))
    placed = first.select("gram", F.struct("node", "size", F.col("node").alias("root"), "pos").alias("x"))
    met = ngram_join._open_pairs(placed, nodes, ngram_join.PARTS).select("x.node", "y.node").collect()
    assert {tuple(m) for m in met} == {(2 * i, 2 * i + 1) for i in range(40)}
    roots = {r.node: r.root for r in ngram_join.link_components(nodes).collect()}
    assert roots == {n: n - n % 2 for n in sets}


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, 20).astype(np.uint64)]))
        bits = sum(int(x).bit_count() for x in (ngram_join.parity(a) ^ ngram_join.parity(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_scores(odd, empty):
    got = ppm.score_corpus(odd, F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)), word_share=0.01).collect()
    train = [r for r in odd_rows() if r[0] is not None and r[0] % 2 == 0]
    counts = Counter(w for r in train for w in [*ppm.tokens(r[1]), None])
    seen, kinds = sum(counts.values()), len(counts)
    want = sorted(
        (len(t) + 1, sum(counts[w] > 0 for w in [*t, None]), seen, round(sum(math.log10((counts[w] + 1) / (seen + kinds + 1)) for w in [*t, None]), 6))
        for t in (ppm.tokens(r[1]) for r in odd_rows())
    )
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert ppm.score_corpus(empty, F.lit(True)).count() == 0
    nothing = ppm.score_corpus(odd, F.lit(False)).collect()
    assert all(math.isclose(r.score, -math.log10(256) * (len(b" ".join(ppm.tokens(t))) + 1), rel_tol=1e-9) for r, t in zip(
        sorted(nothing, key=lambda r: r.score), sorted((x[1] for x in odd_rows()), key=lambda t: -len(b" ".join(ppm.tokens(t))))))


def brute_walk(text: bytes, history: list[bytes], order: int, least: float) -> float:
    """Partial matching by the definition, with dictionaries."""
    tables = [defaultdict(Counter) for _ in range(order + 1)]
    for body in history:
        stream = b"\n" * order + body
        for p in range(order, len(stream)):
            for k in range(order + 1):
                tables[k][stream[p - k:p]][stream[p]] += 1
    total, stream = 0.0, b"\n" * order + text
    for p in range(order, len(stream)):
        excluded, done = set(), False
        for k in range(order, -1, -1):
            all_ = tables[k][stream[p - k:p]]
            node = {s: c for s, c in all_.items() if c >= least}
            if not node:
                continue
            mass = sum(all_.values()) - sum(node[s] for s in excluded)
            new = {s: c for s, c in node.items() if s not in excluded}
            if stream[p] in new:
                total += math.log10((new[stream[p]] - ppm.DISCOUNT) / mass)
                done = True
                break
            pruned = sum(all_.values()) - sum(node.values())
            if new:
                total += math.log10(min(1.0, (pruned + ppm.DISCOUNT * len(new)) / mass))
            excluded = set(node)
        if not done:
            total -= math.log10(256 - len(excluded))
    return total


@pytest.mark.parametrize("share", [1e-9, 0.01])
def test_trie_by_definition(spark, share):
    docs = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "mat"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs + ["the cow sat on zebras"])], "doc_id int, text string")
    got = {r.doc_id: r.score for r in ppm.score_corpus(df, F.col("doc_id") < 4, order=3, node_share=share).collect()}
    history = [t.encode() + b"\n" for t in docs]
    least = max(1.0, share * sum(map(len, history)))
    for i, t in enumerate(docs + ["the cow sat on zebras"]):
        assert math.isclose(got[i], brute_walk(t.encode() + b"\n", history, 3, least), rel_tol=1e-9)


def test_every_counted_context_takes_part(spark):
    """Also with so few broadcast contexts that nearly all are joined, and with training rows that are few."""
    rng = random.Random(8)
    docs = [" ".join(rng.choice(["the", "cat", "dog", "zebra", "É", "sat"]) + rng.choice(["", "s", "x"]) for _ in range(rng.randint(0, 12))) for _ in range(30)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id int, text string").repartition(4)
    bodies = [b" ".join(ppm.tokens(t)) + b"\n" for t in docs]
    for order, learned in ((5, 20), (1, 3)):
        want = [brute_walk(b, bodies[:learned], order, 1) for b in bodies]
        for share in (0.3, 5e-7):
            got = {r.doc_id: r.score for r in ppm.score_corpus(df, F.col("doc_id") < learned, order=order, node_share=share).collect()}
            assert all(math.isclose(got[i], w, rel_tol=1e-9) for i, w in enumerate(want))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_lines(rows, edits, min_chars):
    firsts = {}
    for i, t in sorted((r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None):
        for no, line in enumerate(t.split("\n")):
            if line.strip():
                firsts.setdefault(line, (i, no))
    order = sorted(firsts, key=firsts.get)
    near = {x for n, x in enumerate(order) if len(x) >= min_chars and any(
        len(y) >= min_chars and abs(len(x) - len(y)) <= edits and edit_distance(x, y) <= edits for y in order[:n])}
    out = {}
    for i, t in ((r[0], r[1]) for r in rows):
        cut = t.split("\n") if t is not None else []
        kept = [no for no, line in enumerate(cut) if i is None or not line.strip() or (firsts[line] == (i, no) and line not in near)]
        mine = [line for no, line in enumerate(cut) if line.strip() and i is not None and firsts[line] == (i, no)]
        out[i] = (len(cut), sum(1 for line in mine if line in near), kept)
    return out


@pytest.mark.parametrize("edits,bit_parallel", [(1, True), (2, True), (2, False)])
def test_line_dedup(spark, edits, bit_parallel):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdefgh é") for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                at = rng.randrange(len(line))
                line[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "é"])
            lines.append("".join(line))
        rows.append((i, "\n".join(lines + rng.choice([[], ["short"], [""], ["  "]]))))
    rows += [(50, None), (51, ""), (None, stems[0]), (52, LONG)]
    got = {r.doc_id: (r.n_lines, r.n_near, list(r.kept)) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), edits=edits, bit_parallel=bit_parallel).collect()}
    assert got == brute_lines(rows, edits, line_dedup.MIN_CHARS)


def test_line_dedup_odd(odd, empty):
    assert line_dedup.dedup_lines(odd).count() == len(odd_rows())
    assert line_dedup.dedup_lines(empty).count() == 0
    cleaned = {r.doc_id: r.text for r in line_dedup.without_copied_lines(odd).collect()}
    assert cleaned[0] is None and cleaned[13] == "x\n\ny  z"
