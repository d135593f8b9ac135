"""Vector codes, importance resampling and language identification against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridlake.llm import importance_resampling, language_id, queries, vector_codes
from gridlake.llm.runtime import documents

ODD_TEXTS = [(1, ""), (2, None), (3, "Ünd der die das " * 4000), (4, "a"), (5, "12 34 -- 56"), (6, "a"), (None, "ein kurzer Text über Öl"), (7, "\x00\x1f .,;"), (8, "x" * 70_000), (8, "the cat and the dog and the cat " * 3), (9, "日本語 テキスト")]


def by_id(df):
    return {r[0]: r for r in df.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward rows, with columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, rank int, score string, n_words int, weight double, place int, h int, held_out int, spoken int, bucket int, fit int, n int"
    return spark.createDataFrame([(*r, ("de", "en", None)[i % 3], *[1, "s", 2, 0.5, 3, 4, 5, 6, 7, 8, 9]) for i, r in enumerate(ODD_TEXTS)], schema)


# 11. Vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, vector, label) in; every distance of every part is computed."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def assigned():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assigned()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    of = Counter()
    for (_, _, label), e in zip(kept, errors):
        of[label] += e
    return sorted((r[0], "".join(f"{k:02x}" for _, k in f), e, of[r[2]], digest) for r, f, e in zip(kept, found, errors))


def test_vector_codes_as_plain(spark, sf):
    rows = documents(spark, sf, "embeddings").select("vec_id", "embedding", "label").collect()
    got = sorted(map(tuple, queries.op11_vector_codes(spark, sf).collect()))
    assert got == plain_codes([tuple(r) for r in rows])


def test_vector_codes_odd_rows(spark):
    rng = np.random.default_rng(3)
    some = [(i, rng.integers(-3, 4, 32).astype(float).tolist(), i % 3 or None) for i in range(5, 120)]
    same = [(200 + i, some[7][1], 7) for i in range(40)] + [(20, some[15][1], 1)] * 3
    bad = [(1, None, 1), (2, [], 1), (3, [None] * 32, 1), (4, [float("nan")] + [0.0] * 31, 1), (6, [float("inf")] + [1.0] * 31, 2), (300, [1.0] * 16, 1), (301, [1.0] * 7, 1), (302, [1e30] + [0.0] * 31, None)]
    schema = "vec_id long, embedding array<double>, label int, code string, error int, vector int, _label int"
    table = spark.createDataFrame([(*r, "c", 1, 2, 3) for r in some + same + bad], schema)
    got = sorted(map(tuple, vector_codes.compression_report(table).collect()))
    clipped = [(i, [min(x, 2.0**19) for x in v] if i == 302 else v, label) for i, v, label in some + same + bad]
    assert len(got) > 100 and got == plain_codes(clipped)
    without = table.where("vec_id <> 302")
    assert sorted(map(tuple, vector_codes.compression_report(without).collect())) == plain_codes([r for r in some + same + bad if r[0] != 302])
    few = table.where("vec_id BETWEEN 5 AND 9 AND label IS NOT NULL")
    assert sorted(map(tuple, vector_codes.compression_report(few).collect())) == plain_codes([r for r in some + bad if r[0] in range(5, 10) and r[2]])
    for none in (table.where("false"), table.where("vec_id <= 4")):
        out = vector_codes.compression_report(none)
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0


def test_equal_average_search_skips_and_ties():
    rng = np.random.default_rng(5)
    for width in (1, 3, 4, 9):
        entries, parts = rng.integers(-6, 7, (50, width)), rng.integers(-8, 9, (700, width))
        distance = ((parts[:, None] - entries) ** 2).sum(axis=2)
        index, best = vector_codes.nearest(parts, entries)
        assert (index == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()


def test_label_sums_beyond_the_broadcast(spark):
    coded = spark.createDataFrame([(i, i % 5 or None, bytes([i % 7]), i) for i in range(300)], "vec_id long, label int, code binary, error long")
    few, many = (sorted(map(tuple, vector_codes.label_sums(coded, n).collect()), key=lambda r: r[0]) for n in (100, 2))
    assert few == many and len(few) == 300
    assert {r[4] for r in few if r[1] is None} == {sum(range(0, 300, 5))}


def test_decoded_vectors_are_near(spark, sf):
    vectors = documents(spark, sf, "embeddings")
    rows = vector_codes.usable(vectors, "vec_id", "embedding", "label")
    books = vector_codes.train(rows)
    coded = vector_codes.encode(rows, books)
    near = by_id(vector_codes.decode(coded, books))
    error = {r["vec_id"]: r["error"] for r in coded.collect()}
    for r in vectors.limit(50).collect():
        apart = sum((a - b) ** 2 for a, b in zip(r["embedding"], near[r["vec_id"]]["vector"])) * 256**2
        # Cells are one unit wide, so each component is off by half a unit at most.
        assert abs(math.sqrt(apart) - math.sqrt(error[r["vec_id"]])) <= math.sqrt(64) / 2 + 1e-6


# 12. Importance resampling


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain_resampling(docs, target):
    s, t = (Counter(b for text in texts for b in plain_features(text)[1]) for texts in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000))))
    out = []
    for doc_id, text in docs:
        words, found = plain_features(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = defaultdict(list)
    for k, r in enumerate(fit[: 5 * len(fit) // 100], 1):
        rank[r].append(k)
    return Counter((r[0], r[2], r[3], r[4], rank[r].pop() if rank[r] else None) for r in out)


def test_resampling_as_plain(spark, sf):
    docs = [tuple(r) for r in documents(spark, sf).select("doc_id", "text").collect()]
    target = [r[0] for r in documents(spark, sf, "benchmark").select("text").collect()]
    got = Counter(map(tuple, queries.op12_importance_resampling(spark, sf).collect()))
    assert got == plain_resampling(docs, target) and sum(r[4] is not None for r in got) == 5 * sum(plain_features(x)[0] >= 20 for _, x in docs) // 100


def test_resampling_odd_rows(spark, odd):
    target = spark.createDataFrame([("the cat and the dog", 1), (None, 2), ("", 3)], "text string, bucket int")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert Counter(map(tuple, importance_resampling.resampling_report(odd, target).collect())) == plain_resampling(rows, ["the cat and the dog", None, ""])
    many = odd.where("doc_id = 3 OR doc_id = 8").crossJoin(spark.range(40).select())
    rows = [tuple(r) for r in many.select("doc_id", "text").collect()]
    got = importance_resampling.resampling_report(many, target.where("false")).collect()
    assert Counter(map(tuple, got)) == plain_resampling(rows, []) and max(r["rank"] or 0 for r in got) == 4
    assert importance_resampling.resampling_report(odd.where("false"), target).count() == 0
    kept = importance_resampling.resampled(many, target)
    assert kept.columns == many.columns and kept.count() >= 4


def test_pieces_of_long_texts():
    text = ("Ab c-d éf 12 " * 50).encode()
    whole = Counter(plain_features(text.decode())[1])
    for piece in (1, 2, 7, 64, 10_000):
        parts = list(importance_resampling.buckets(text, piece=piece))
        assert sum((Counter(b) for _, b in parts), Counter()) == whole and sum(n for n, _ in parts) == 250


# 13. Language identification


def test_language_held_out_accuracy(spark):
    """Rows that training never saw, on the middle table: at least 99 in 100 are right."""
    sf = "/root/testdata/sf0.01"
    told = {r["doc_id"]: r["lang"] for r in documents(spark, sf).collect()}
    out = queries.op13_language_id(spark, sf).collect()
    assert len(out) == len(told) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"]]
    assert len(held) > 200 and sum(r["lang_pred"] == told[r["doc_id"]] for r in held) >= 0.99 * len(held)


def test_language_network_as_plain_loops():
    rng = np.random.default_rng(2)
    net = language_id.Network.drawn(["a", "b", "c"], rng)
    net.bias[:] = rng.normal(0, 0.5, len(net.bias))
    texts = ["", "Abc DEF 12", "é" * 400, "x y " * 200]
    data = [t.encode() for t in texts]
    at = np.cumsum([0, *map(len, data)])
    got = net.predict(np.frombuffer(b"".join(data), np.uint8), at)
    for row, raw in zip(got, data, strict=True):
        total, weight = np.zeros(3), 0.0
        starts = range(0, max(1, len(raw) - 3), 253)
        for start in starts:
            x = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in raw[start : start + 256]).ljust(256)
            peaks = [max(sum(float(f[j, x[p + j], k]) for j in range(len(f))) for p in range(256 - len(f) + 1)) for f in net.filters for k in range(16)]
            hidden = np.maximum(np.array(peaks) + net.bias, 0)
            e = np.exp(hidden @ net.out + net.out_bias)
            w = sum(c != 32 for c in x) + 1e-6
            total, weight = total + w * e / e.sum(), weight + w
        assert np.allclose(row, total / weight, atol=1e-4)


def test_language_gradients():
    """The steps of training follow the loss: finite differences of some parameters."""
    rng = np.random.default_rng(4)
    net = language_id.Network.drawn(["a", "b"], rng)
    net = language_id.Network(net.langs, [f.astype(np.float64) for f in net.filters], net.bias.astype(np.float64) + 0.1, net.out.astype(np.float64), net.out_bias.astype(np.float64))
    x, y = rng.integers(97, 105, (6, 256)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])
    loss = lambda: -np.log(net.softmax(net.pooled(x))[np.arange(6), y]).mean()
    for p, g in zip(net.parameters(), net.gradients(x, y), strict=True):
        for i in np.argsort(-abs(g), axis=None)[:3]:
            old = p.flat[i]
            p.flat[i] = old + 1e-6
            up = loss()
            p.flat[i] = old - 1e-6
            down = loss()
            p.flat[i] = old
            assert abs((up - down) / 2e-6 - g.flat[i]) < 1e-5


def test_language_odd_rows(spark, odd):
    out = language_id.language_report(odd).collect()
    assert len(out) == odd.count()
    for r in out:
        if r["doc_id"] in (1, 2, 5, 7):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("de", "en") and 0 < r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    one = language_id.language_report(odd.withColumn("lang", odd.lang.substr(9, 1))).collect()
    assert {r["lang_pred"] for r in one} == {"und", ""}
    none = language_id.language_report(odd.withColumn("lang", odd.text.substr(0, 0)).where("false"))
    assert none.count() == 0 and none.columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_language_needs_no_labels_of_held_out_rows(spark, sf):
    """Labels of held-out rows, sources and other ids' order change no prediction."""
    from pyspark.sql import functions as F

    docs = documents(spark, sf)
    swapped = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert by_id(language_id.language_report(docs)) == by_id(language_id.language_report(swapped))


# Near copies of very long texts


def _turn(sets, chunk=0, key=1):
    """Rows of one turn of a bucket as a task gets them."""
    import pyarrow as pa

    from gridlake.llm import near_copies

    n = len(sets)
    columns = {
        "key": [key] * n, "chunk": [chunk] * n, "other": [chunk] * n, "own": [chunk] * n, "node": [i.to_bytes(16, "big") for i in range(n)], "mark": list(range(n)),
        "size": [len(s) for s in sets], "print": [near_copies.wide_fingerprint(s).tobytes() for s in sets], "hashes": [s.tobytes() for s in sets],
    }
    kinds = {"key": pa.int64(), "chunk": pa.int32(), "other": pa.int32(), "own": pa.int32(), "node": pa.binary(), "mark": pa.int64(), "size": pa.int32(), "print": pa.binary(), "hashes": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in columns.items()], list(columns))


def test_near_pairs_of_long_texts_stay_within_memory():
    """One turn of 100 sets of 20,000 shingles, half of them near copies of one text, with the table of common shingles and without."""
    import tracemalloc

    from gridlake.llm import near_copies

    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 20_000, np.uint64)
    sets = []
    for i in range(100):
        own = base.copy()
        changed = rng.choice(20_000, 1000 if i % 2 else 6000, replace=False)
        own[changed] = rng.integers(0, 1 << 63, len(changed), np.uint64)
        sets.append(np.unique(own))
    near = lambda a, b: (s := len(np.intersect1d(sets[a], sets[b]))) >= 0.8 * (len(sets[a]) + len(sets[b]) - s)
    found = {}
    for most in (64 << 20, 0):
        before, near_copies.shared_bits.__defaults__ = near_copies.shared_bits.__defaults__, (most,)
        try:
            tracemalloc.start()
            out = list(near_copies._near_pairs(0.8)(iter([_turn(sets)])))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
            near_copies.shared_bits.__defaults__ = before
        assert peak < 400 << 20
        links = [(int.from_bytes(a, "big"), int.from_bytes(b, "big")) for batch in out for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
        assert all(near(a, b) for a, b in links)
        root = list(range(100))
        for a, b in links:
            root = [root[a] if r == root[b] else r for r in root]
        found[most] = root
        odd = {root[i] for i in range(1, 100, 2)}
        assert len(odd) == 1 and all(root.count(root[i]) == 1 for i in range(0, 100, 2))
    assert len(set(map(tuple, (sorted(map(tuple, ([i for i, r in enumerate(v) if r == x] for x in set(v)))) for v in found.values())))) == 1


def test_long_texts_are_dealt_in_chunks_of_bytes(spark, monkeypatch):
    """The chunks of a bucket are cut by shingles as well as by rows, and near copies are found across them."""
    from gridlake.llm import near_copies

    monkeypatch.setattr(near_copies, "CHUNK_HASHES", 2000)
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(4000)]
    base = rng.choice(words, 400).tolist()
    rows = []
    for i in range(24):
        own = list(base)
        for k in range(i * 13 % 390, i * 13 % 390 + 6):
            own[k] = f"x{i}k{k}"
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join(rng.choice(words, 300).tolist())) for i in range(6)]
    kept = sorted(r["doc_id"] for r in near_copies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    root = __import__("brute").jaccard_roots([t for _, t in rows])
    assert kept == sorted({min(rows[j][0] for j in range(len(rows)) if root[j] == root[i]) for i in range(len(rows))})
