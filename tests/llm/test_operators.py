"""Operators against brute force, on the smallest tables and on a table of awkward rows."""

import hashlib
import itertools
import json
import math
import os
import random
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import xxhash
from brute import ODD, base, brute_matches, conversations, jaccard_roots
from pyspark.sql import functions as F

from gridlake.llm import attention_mil, bpe_tree, licences, near_copies, quality_rules, quote_links, secrets, sentence_spans, simhash, suffixes, token_shards
from gridlake.llm.components import components
from gridlake.llm.runtime import documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
CLASH = {"fingerprint": 1, "spans": "x", "n_words": 2, "component_id": 3, "score": 0.5, "hash": "h", "first": 9, "items": "i", "ids": "j", "kept": False, "lang": None}


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id long, text string, fingerprint int, spans string, n_words int, component_id int, score double, hash string, first int, items string, ids string, kept boolean, lang string"
    return spark.createDataFrame([(*r, *CLASH.values()) for r in ODD], schema)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return documents(spark, sf)


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def multiset(rows):
    return Counter(map(repr, rows))


# 1. Byte-level BPE


def test_bpe_equals_whole_text_encoding():
    vocab = bpe_tree.vocabulary(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(5)
    mixed = ["a", " ", "\n", "'s", "'ll", "é", "ß", "1", "23", "!", "\t", " ", "th", "ing", "漢", "🎉", "\x1c", "'", "   "]
    letters = ["th", "he", "in", "a", "e", "s", "q"]
    for k in range(1500):
        text = "".join(rng.choice(mixed if k % 2 else letters) for _ in range(rng.randint(0, 300)))
        whole = vocab.leaf(text)
        for leaf, window in ((1, 1), (7, 3), (50, 16)):
            assert bpe_tree.encode(vocab, text, leaf, window) == whole
        assert bpe_tree.decode(vocab, whole, 3) == text.encode()


def test_bpe_ranks_are_reached_by_merges():
    vocab = bpe_tree.vocabulary(RANKS, public_tokenizers.PATTERN)

    def merge(piece):
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            rank, i = min((vocab.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    assert all(merge(token) == [token] for token in vocab.ranks)


def test_bpe_report(odd, empty):
    found = bpe_tree.token_digests(bpe_tree.encode_documents(odd, RANKS, public_tokenizers.PATTERN)).collect()
    vocab = bpe_tree.vocabulary(RANKS, public_tokenizers.PATTERN)
    expected = []
    for i, text in ODD:
        ids = vocab.leaf(text or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert multiset(map(tuple, found)) == multiset(expected)
    assert bpe_tree.encode_documents(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# 2. Licences


def test_licences(spark, odd, empty):
    mit = licences.KNOWN[3][1]
    rows = [(1, "Copyright (c) 2020 Somebody\n\n" + mit.replace("sublicense", "sub-licence").upper()), (2, f"Intro.\n\n{mit}\n\nOutro."), (3, mit[:-40]), (4, "x\nLicensed under the Apache Licence, version 2.0!\ny")]
    found = by_id(licences.licence_report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [(found[i]["whole_licence"], found[i]["licences"], found[i]["n_matches"]) for i in (1, 2, 3, 4)] == [("MIT", "MIT", 1), (None, "MIT", 1), (None, "", 0), (None, "Apache-2.0", 1)]
    assert by_id(licences.licence_report(odd))[8]["whole_licence"] == "MIT"
    assert licences.licence_report(odd).count() == len(ODD)
    again = spark.createDataFrame([(1, mit), (1, mit), (None, mit), (None, None)], "doc_id long, text string")
    assert multiset(map(tuple, licences.licence_report(again).collect())) == multiset([(1, "MIT", "MIT", 1)] * 2 + [(None, "MIT", "MIT", 1), (None, None, "", 0)])
    assert licences.licence_report(empty).count() == 0
    assert licences.licence_report(odd, spark.createDataFrame([], "licence string, text string")).where("n_matches > 0").count() == 0


def test_published_licence_files(spark):
    full = {name: text for name, text in licences.KNOWN if len(text) > 500 and name != "Apache-2.0"}
    files = {k: f"{k} License\n\nCopyright (c) 2020 Somebody\n\n" + "\n\n".join(textwrap.fill(p, 78) for p in text.split("\n")) for k, text in full.items()}
    isc = full["ISC"].replace("the above copyright", "the above\ncopyright").replace("\n", "\n\n").replace("above\n\ncopyright", "above\ncopyright")
    rows = [(k, text) for k, text in files.items()] + [(f"pasted {k}", f"Intro.\n\n{text}\n\nOutro.") for k, text in files.items()] + [("wrapped", isc)]
    found = by_id(licences.licence_report(spark.createDataFrame(rows, "doc_id string, text string")))
    assert set(files) == {"MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Zlib"}
    for k in files:
        n = 3 if k == "Unlicense" else 1  # its first paragraph is a known notice too
        assert (found[k]["whole_licence"], found[k]["licences"], found[k]["n_matches"]) == (k, k, n)
        assert (found[f"pasted {k}"]["whole_licence"], found[f"pasted {k}"]["licences"], found[f"pasted {k}"]["n_matches"]) == (None, k, n)
    assert found["wrapped"]["whole_licence"] == "ISC"


COMMON = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no licence files on this machine")
@pytest.mark.parametrize("max_sizes", [20_000, 0])
def test_a_folder_of_whole_licences(spark, monkeypatch, max_sizes):
    monkeypatch.setattr(licences, "MAX_SIZES", max_sizes)
    names = ["Apache-2.0", "GPL-3", "MPL-2.0"]
    texts = {n: open(f"{COMMON}/{n}", encoding="utf-8").read() for n in names}
    rows = [(n, t) for n, t in texts.items()] + [(f"respelled {n}", re.sub(r"(?m)^[ \t]+|[ \t]+$", "", t).replace("License", "Licence").replace("https://", "http://").upper()) for n, t in texts.items()]
    rows += [(f"pasted {n}", f"Intro.\n\n{t}\n\nOutro.") for n, t in texts.items()] + [(f"part {n}", t[: len(t) // 2]) for n, t in texts.items()]
    known = licences.licence_folder(spark, COMMON).where(F.col("licence").isin(names))
    found = {r["doc_id"]: (r["whole_licence"], r["licences"]) for r in licences.licence_report(spark.createDataFrame(rows, "doc_id string, text string"), known).collect()}
    for n in names:
        assert [found[f"{k}{n}"] for k in ("", "respelled ", "pasted ", "part ")] == [(n, n), (n, n), (None, n), (None, "")]


# 3. Secrets

def test_secret_base_spans(docs, texts, odd, empty):
    for i, row in by_id(secrets.secret_report(docs)).items():
        assert row["base_sha256"] == hashlib.sha256(base(texts[i]).encode()).hexdigest()
        assert set(filter(None, base(texts[i]).split(","))) <= set(row["spans"].split(","))
    assert secrets.secret_report(odd).count() == len(ODD)
    assert secrets.secret_report(empty).count() == 0
    for text in ("secret=token:abcdefgh", "ſecret: abcdefg", "toKen=abcdefg", "AKIAAKIA" + "A" * 20, "TOKEN = 'ab.c=d'"):
        assert secrets.base_spans(text) == sorted((a, {"assign": 0, "access": 1, "hex": 2}[k], b) for k, a, b in ((s.split(":")[0], *map(int, s.split(":")[1:])) for s in filter(None, base(text).split(","))))


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def test_battery_equals_plain_loops():
    rng = random.Random(5)
    letters = "etaoinshrdlcumwfgypbvkjxqz"
    pairs = {a + b: rng.randrange(1, 400) if b in letters[:12] else rng.randrange(3) for a in ALNUM[26:52] for b in ALNUM[26:52]}
    usage = secrets.Usage(letters, tuple(pairs[a + b] for a in ALNUM[26:52] for b in ALNUM[26:52]))
    for e, (alphabet, _) in enumerate(secrets.ENCODINGS):
        runs = ["".join(rng.choice(alphabet if rng.random() < 0.6 else alphabet[:7]) for _ in range(rng.choice([20, 21, 33, 80, 400]))) for _ in range(40)] + [alphabet[0] * 30]
        assert np.allclose(secrets.battery(runs, e, secrets.Usage(letters)), [brute.battery(r, alphabet, letters) for r in runs], rtol=1e-9, atol=1e-9)
        assert np.allclose(secrets.battery(runs, e, usage), [brute.battery(r, alphabet, letters, pairs) for r in runs], rtol=1e-9, atol=1e-9)
    assert secrets.battery([], 0).size == 0


def test_log_p_bounds_the_normal_tail(spark):
    lines = [(0.5, 0.4, 0.3), (-1.0, 0.6, 0.5)]
    rows = [(e, n, d) for e in (0, 1) for n in (20, 50, 300) for d in (0.0, 0.3, 2.0, 9.0, 40.0)]
    table = spark.createDataFrame(rows, "encoding int, size int, distance double")
    for e, n, d, p in table.select("*", secrets.log_p(F.col("encoding"), F.col("size"), F.col("distance"), lines)).collect():
        a, b, s = lines[e]
        z = (d**0.5 - a - b * n**0.5) / s
        exact = math.log10(math.erfc(-z / 2**0.5) / 2) if z > -35 else None
        assert p <= 0 and (exact is None or exact - 1e-9 <= p <= max(0.0 if z >= 0 else exact + 0.07, exact + 0.07))


def test_threshold_is_the_step_up_procedure(spark):
    rng = random.Random(6)
    rows = [(rng.choice([20, 30, 64, 200]), rng.uniform(-6, -1.5) if rng.random() < 0.3 else math.log10(rng.random())) for _ in range(3000)]
    mean, cut = secrets.threshold(spark.createDataFrame(rows, "size int, log_p double"), 0.05)
    weights = [min(64, n) / mean for n, _ in rows]
    assert abs(sum(weights) - len(rows)) < 1e-6
    exact = brute.benjamini_hochberg([10**p for _, p in rows], weights, 0.05)
    found = {i for i, ((_, p), w) in enumerate(zip(rows, weights, strict=True)) if p - math.log10(w) <= cut}
    assert found <= exact and len(found) >= 0.97 * len(exact) > 300
    assert secrets.threshold(spark.createDataFrame([], "size int, log_p double"), 0.05) == (1.0, -math.inf)


def test_secrets_among_written_names(spark, texts):
    """Recall of drawn keys of many encodings, and the share of finds that people wrote, in prose and without any."""
    rng = random.Random(8)
    prose = [t for t in texts.values() if len(t) > 300]
    drawn = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    uuid = lambda: "-".join(drawn("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))
    kinds = {"base62 32": lambda: drawn(ALNUM, 32), "base62 40": lambda: drawn(ALNUM, 40), "base62 700": lambda: drawn(ALNUM, 700), "lower 40": lambda: drawn(ALNUM[26:52], 40), "base58 44": lambda: drawn("".join(c for c in ALNUM if c not in "0OIl"), 44), "letters 48": lambda: drawn(ALNUM[:52], 48), "base36 40": lambda: drawn(ALNUM[26:], 40), "base64 64": lambda: drawn(ALNUM + "+/", 64), "uuid": uuid}
    keys = [(k, make()) for k, make in kinds.items() for _ in range(60)]
    words = "user profile setting version controller handler index final name pass word login request buffer token parse error config manager service stream reader table column value".split()
    named = []
    for k in range(3000):
        some = [rng.choice(words) for _ in range(rng.randint(4, 8))]
        styles = ["".join(w.capitalize() for w in some), "_".join(some), "".join(f"{w}{i}" for i, w in enumerate(some, 1)), "".join(some) + "12", "-".join(some).upper(), "".join(w.capitalize() for w in some) + str(2000 + k % 40)]
        named.append(styles[k % len(styles)])
    named.append("user1name2pass3word4login5")
    for with_prose in (True, False):
        rows = [(i, f"use {k} now") for i, (_, k) in enumerate(keys)] + [(10_000 + i, f"see {n} there") for i, n in enumerate(named)]
        rows += [(20_000 + i, t) for i, t in enumerate(prose)] if with_prose else []
        found = by_id(secrets.secret_report(spark.createDataFrame(rows, "doc_id long, text string")))
        whole = {k: 0 for k in kinds}
        for i, (kind, key) in enumerate(keys):
            whole[kind] += f"4:{4 + len(key)}" in found[i]["spans"]
        wrong = sum("random" in found[10_000 + i]["spans"] for i in range(len(named)))
        assert all(n >= 54 for n in whole.values()), whole
        assert wrong <= 0.1 * len(keys) and found[10_000 + len(named) - 1]["spans"] == ""


def test_letter_usage_as_counted(spark, docs, texts):
    pairs, alone = Counter(), Counter()
    for t in texts.values():
        t = "".join(c.lower() if c.isascii() else "\0" for c in t)
        alone.update(t)
        pairs.update(a + b for a, b in zip(t, t[1:], strict=False))
    usage = secrets.letter_usage(docs, "text")
    assert usage.letters == "".join(sorted(ALNUM[26:52], key=lambda c: (-alone[c], c)))
    assert usage.pairs == tuple(pairs[a + b] for a in ALNUM[26:52] for b in ALNUM[26:52])
    assert secrets.letter_usage(docs.where("false"), "text") == secrets.Usage()


def test_secrets_in_a_very_long_text(spark):
    """Five MB of settings: a hundred thousand base spans beside a hundred thousand runs, in time that grows with the length."""
    line = "token=ab12cd{:05d} some_setting_of_the_reader_{:05d}\n"
    text = "".join(line.format(i, i) for i in range(100_000))
    began = time.monotonic()
    found = secrets.redacted(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]["text"]
    assert time.monotonic() - began < 60
    assert len(text) > 5_000_000 and found.count("[SECRET]") == 100_000 and "ab12cd" not in found
    taken = secrets.base_spans(text[:2000])
    assert [x for x in secrets.candidates(text[:2000], taken)] == [x for m in secrets.RUN.finditer(text[:2000]) if not any(a < m.end() and m.start() < b for a, _, b in taken) for x in secrets.pieces(m[0], m.start()) if len(x[2]) * math.log2(len(secrets.ENCODINGS[x[3]][0])) >= secrets.MIN_BITS]


def test_scratch_tables_are_deleted(spark, odd):
    from gridlake.llm import runtime

    made = []
    out = runtime.kept(spark, lambda: (made.append(runtime.written(odd.select("doc_id"), "step")), made[0].distinct())[1], "end")
    assert out.count() == len({i for i, _ in ODD})
    there = lambda df: os.path.exists(df.inputFiles()[0].removeprefix("file://"))
    assert there(out) and not there(made[0])


def test_runs_of_mixed_alphabets_are_split(spark):
    key = "q7Zp2Lx9Vb4Tn8Rk3Wd6Ym1Hs5Jc0GfAeUoXiQzBtNvPlKhM"
    assert [(a, x) for a, _, x, _ in secrets.pieces(f"path/to_my-{key}/x+y")] == [(5, f"to_my-{key}")]
    assert [(a, x) for a, _, x, _ in secrets.pieces(f"the_name-{key[:20]}+/{key[20:]}")] == [(9, f"{key[:20]}+/{key[20:]}")]


def test_redaction(spark):
    rows = [(1, "a token = 'abcdef123' b", 5), (2, "clean", 5), (3, None, 5), (4, "key " + "0123456789abcdef" * 2 + " secret: " + "f" * 30 + " z", 5)]
    out = by_id(secrets.redacted(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")))
    assert [out[i]["text"] for i in (1, 2, 3, 4)] == ["a [SECRET]' b", "clean", None, "key [SECRET] [SECRET] z"]


def test_secrets_with_clashing_columns(spark):
    rows = [(1, "a token = 'abcdef123' b"), (2, None)]
    names = ["base", "spans", "found", "drawn", "each", "Spans_", "_base", "_found"]
    table = spark.createDataFrame([(*r, *range(len(names))) for r in rows], ["doc_id", "text", *names])
    out = secrets.redacted(table)
    assert out.columns == table.columns and by_id(out)[1]["text"] == "a [SECRET]' b" and tuple(by_id(out)[2])[2:] == tuple(range(len(names)))
    assert secrets.with_spans(table).columns[-2:] == ["base_", "spans__"]


# 4. Quotation links


def test_quote_links(spark):
    rows = [
        (1, 0, "user", "Hello there my friend.\nHow do I sort a list?"), (1, 1, "assistant", "> How do I sort a list?\n\nUse sorted()."), (1, 2, "user", "Thanks a lot."),
        (1, 3, "user", "Ann wrote:\n> Use sorted().\n>> How do I sort a list?\n\nDoes it copy?"), (1, 4, "assistant", "yes"), (1, 5, "user", "> HELLO   there my friend.\nhi"), (1, 6, "user", "> Does it copy?\nindeed"),
        (2, 0, "user", None), (2, 5, "user", "> Use sorted().\nno link"), (None, 1, "user", "lost"), (3, 0, "user", "dup"), (3, 0, "user", "dup"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["turn"]): r for r in quote_links.linked_conversations(table).collect()}
    assert [found[1, t]["reply_to"] for t in range(7)] == [None, 0, 1, 1, 3, 0, 3]
    assert [t for _, t in sorted((found[1, t]["position"], t) for t in range(7))] == [0, 5, 1, 3, 6, 4, 2]
    assert [found[1, t]["text"] for t in (1, 3, 5)] == ["Use sorted().", "Does it copy?", "hi"]
    assert (found[1, 3]["n_passages"], found[1, 3]["n_linked"], found[1, 3]["quote_depth"]) == (2, 2, 2)
    assert (found[2, 5]["reply_to"], found[2, 5]["n_linked"], found[2, 0]["text"], found[None, 1]["position"]) == (0, 0, "", None)
    assert quote_links.linked_conversations(table).count() == len(rows)
    assert quote_links.conversation_report(table.where("false")).count() == 0


def test_turns_over_several_stretches(spark, monkeypatch):
    monkeypatch.setattr(quote_links, "STRETCH", 3)
    turns = spark.createDataFrame([(1, t * 2, 2 if t == 7 else None) for t in range(12)], "conv_id long, turn long, linked long")
    found = {r["turn"]: r for r in quote_links.reply_tree(turns).collect()}
    assert [found[t * 2]["reply_to"] for t in range(12)] == [None, 0, 2, 4, 6, 8, 10, 2, 14, 16, 18, 20]
    assert [t for _, t in sorted((r["position"], t) for t, r in found.items())] == [0, 2, 14, 16, 18, 20, 22, 4, 6, 8, 10, 12]


def test_quote_links_of_repeated_rows(spark):
    rows = [(1, 0, "user", "Yes.\nNo."), (1, 1, "assistant", "well"), (1, 2, "user", "> Yes.\n> No.\nboth"), (1, 2, "user", "> Yes.\n> No.\nboth")]
    found = quote_links.linked_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert multiset(map(tuple, found)) == multiset(conversations(rows))
    assert [r["reply_to"] for r in found if r["turn"] == 2] == [0, 0]


@pytest.mark.parametrize("stretch", [512, 3])
def test_generated_threads(spark, stretch, monkeypatch):
    """Nested quotes, repeated rows, null and very long texts and keys, clashing columns, and branches in branches."""
    monkeypatch.setattr(quote_links, "STRETCH", stretch)
    rng = random.Random(stretch)
    rows = [(None, 3, "user", "> lost"), (77, None, "user", "no turn"), (50, 0, "user", None), (50, 1, None, "> \n>> x"), (51, 0, "user", "word " * 40_000), (51, 4, "user", "> " + "word " * 40_000 + "\nmany"), (52, 1, "user", ">" * 40 + " deep")]
    for c in range(25):
        texts = []
        for t in range(rng.randint(1, 30)):
            own = "\n".join(f"Line {rng.randrange(40)} of somebody who talks." for _ in range(rng.randint(1, 3)))
            text = own
            if texts and rng.random() < 0.6:
                far = rng.choice(texts)
                quoted = "\n".join("> " + x for x in (far.split("\n") if rng.random() < 0.7 else rng.sample(far.split("\n"), 1)))
                text = rng.choice(["", "Ann wrote:\n", "so\n"]) + quoted + "\n\n" + own
            texts.append(text)
            rows += [(c, t * rng.choice([1, 1, 1]), rng.choice(["user", "assistant"]), text)] * rng.choice([1, 1, 1, 2])
    # Alternate replies that nest as deep as the thread is long.
    deep = ["The very first message of all."]
    for t in range(1, 24):
        deep.append(f"Answer {t} is a line of its own.\n" if t % 2 else f"> Answer {t - 3} is a line of its own.\nMore {t} on that.\n" if t > 3 else f"More {t} on that.")
    rows += [(99, t, "user", x) for t, x in enumerate(deep)]
    schema = "conv_id long, turn long, role string, text string, key int, own string, position string, place int, linked string"
    table = spark.createDataFrame([(*r, 1, "o", "p", 2, "l") for r in rows], schema)
    assert multiset(map(tuple, quote_links.linked_conversations(table).collect())) == multiset(conversations(rows))


# 5. Sentence spans


def test_sentence_spans(docs, texts, odd, empty):
    seen, gone = {}, defaultdict(set)
    for i in sorted(texts):
        for a, b, h, n in sentence_spans.spans(texts[i]):
            if (h, n) in seen:
                gone[i].update(range(a, b))
            else:
                seen[h, n] = i
    rows = [by_id(sentence_spans.deduplicated(docs, max_broadcast=n)) for n in (10**6, 0)]
    assert rows[0] == rows[1]
    for i, row in rows[0].items():
        found = sentence_spans.sentences(texts[i])
        kept, at = "", 0
        for k, (start, end, _, _) in enumerate(found):
            if k in gone[i]:
                kept += texts[i][at:start]
                at = end
        assert (set(row["removed"]), row["text"], row["n_sentences"]) == (gone[i], kept + texts[i][at:], len(found))
    assert sentence_spans.dedup_report(odd).count() == len(ODD)
    assert sentence_spans.dedup_report(empty).count() == 0


def test_repeated_passages_go_and_short_phrases_stay(spark):
    passage = " ".join(f"Sentence number {n} says word{n} and word{n + 1} again." for n in range(8))
    rows = [(5, f"Before it. {passage} After five."), (2, f"Own start of two. {passage} Own end."), (9, "Thank you. Best regards."), (10, "Thank you. Best regards."), (11, None)]
    found = by_id(sentence_spans.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert (found[2]["n_removed"], found[5]["n_removed"], found[5]["repeats_of"]) == (0, 8, [2])
    assert found[9]["n_removed"] == found[10]["n_removed"] == found[11]["n_removed"] == 0


def test_half_a_hash_in_common_removes_nothing(spark):
    rows = [(d, d, 0, 2, 7, low) for d, low in ((1, 1), (2, 2), (3, 3), (4, 3), (5, 3))] + [(6, 6, 0, 2, 8, 1)]
    table = spark.createDataFrame(rows, "doc_id long, doc_key long, first int, stop int, high long, low long")
    assert sorted((r["doc_id"], r["origin_id"]) for r in sentence_spans.later_places(table).collect()) == [(4, 3), (5, 3)]


def test_texts_without_repeats_do_not_move(spark):
    """Those that lose something are told surely, most others are left where they are; also ids that are null."""
    docs = spark.range(4000).select(F.when(F.col("id") != 5, F.col("id")).alias("doc_id"), (F.col("id") * 3).alias("doc_key"), F.lit("x").alias("text"))
    gone = docs.where("doc_key % 30 = 0 OR doc_id IS NULL").select(F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key"))
    moved, still = sentence_spans.parted(docs, gone)
    assert {r["_key"] for r in gone.collect()} <= {r["doc_key"] for r in moved.collect()}
    assert still.count() > 3000 and moved.count() + still.count() == 4000
    # A bitmap that is full tells nothing, and loses nothing.
    moved, still = sentence_spans.parted(docs, gone, most=1)
    assert {r["_key"] for r in gone.collect()} <= {r["doc_key"] for r in moved.collect()} and moved.count() + still.count() == 4000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_that_do_not_repeat_stay_where_they_are(spark):
    """Only halves of hashes are shuffled to tell which spans repeat; a few others may pass, and are first places."""
    one = spark.range(4000).selectExpr("id AS doc_id", "id AS doc_key", "0 AS first", "2 AS stop", "IF(id % 100 = 1, id - 1, id) AS high", "7L AS low")
    table = sentence_spans.written(one.union(one.where("doc_id = 7").selectExpr("doc_id", "doc_key", "first", "stop", "high", "8L AS low")), "some")
    likely = sentence_spans.likely_repeated(table)
    assert "Exchange hashpartitioning(high" not in plan_of(likely)
    found = {r["doc_id"] for r in likely.collect()}
    assert {k for k in range(4000) if k % 100 < 2} | {7} <= found and len(found) < 1000
    for some in (likely, table, sentence_spans.likely_repeated(table, most=1)):
        assert sorted((r["doc_id"], r["origin_id"]) for r in sentence_spans.later_places(some).collect()) == [(k + 1, k) for k in range(0, 4000, 100)]


def test_spans_in_turns_are_the_same_spans(docs, odd):
    for table in (docs, odd):
        one, many = (multiset(map(repr, sentence_spans.deduplicated(table, turn=n).collect())) for n in (1 << 40, 1 + table.agg(F.sum(F.length("text"))).first()[0] // 3))
        assert one == many


def test_a_long_passage_is_one_range(spark):
    """A copy of 300 sentences is one range and one origin in what is broadcast, so no text is shuffled for it; ranges are those of the spans."""
    passage = " ".join(f"Sentence number {n} says word{n} and word{n + 1} again." for n in range(300))
    rows = [(d, f"Own start of {d}. {passage} Own end {d}.") for d in (1, 2)]
    report = sentence_spans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), max_broadcast=4)
    # Where texts move, those that stay are a union with them.
    assert "Union" not in plan_of(report) and [len(by_id(report)[d]["removed"]) for d in (1, 2)] == [0, 300]
    rng = random.Random(4)
    drawn = {d: [x[:2] for x in sentence_spans.spans(" ".join(" ".join(["w"] * rng.randrange(1, 30)) + "." for _ in range(60))) if rng.random() < d / 40] for d in range(1, 41)}
    places = [(d, d, a, b, o) for d, found in drawn.items() for a, b in found for o in (3, 1)]
    made = sentence_spans.removals(spark.createDataFrame(places, "doc_id long, doc_key long, first int, stop int, origin_id long")).collect()
    assert {r["doc_id"] for r in made} == {d for d in drawn if drawn[d]}
    for row in made:
        gone = [tuple(x) for x in row["gone"]]
        assert sorted({k for a, b in drawn[row["doc_id"]] for k in range(a, b)}) == [k for a, b in gone for k in range(a, b)]
        assert all(b < c for (_, b), (c, _) in itertools.pairwise(gone)) and row["repeats_of"] == [1, 3]


def test_the_end_of_a_passage_is_covered():
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    text = lambda sizes: " ".join(" ".join(word() for _ in range(n)) + "." for n in sizes)
    passage = text((12, 30, 12, 5))
    one, two = (sentence_spans.spans(f"{passage} {text((9, 25))}") for _ in range(2))
    shared = {x[2:] for x in one} & {x[2:] for x in two}
    assert {k for a, b, *x in one if tuple(x) in shared for k in range(a, b)} == {0, 1, 2, 3}


def test_passages_without_full_stops_share_spans():
    rng = random.Random(10)
    run = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    caught = 0
    for _ in range(300):
        passage = run(60)
        one, two = (sentence_spans.spans(f"{run(90)} {passage} {run(90)}") for _ in range(2))
        caught += bool({x[2:] for x in one} & {x[2:] for x in two})
    assert caught >= 291


# 6. SimHash


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashed) * 2 > len(hashed))


def roots(values, radius=4):
    up = list(range(len(values)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


@pytest.mark.parametrize("max_bucket", [8192, 3])
def test_simhash(docs, texts, max_bucket):
    ids = sorted(texts)
    prints = [fingerprint(texts[i]) for i in ids]
    root = roots(prints)
    for row in simhash.near_duplicates(docs, max_bucket=max_bucket).collect():
        k = ids.index(row["doc_id"])
        assert (row["fingerprint"] % (1 << 64), row["component_id"]) == (prints[k], ids[root[k]])


def test_simhash_odd_rows(odd, empty):
    found = Counter((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd).collect())
    assert found == Counter({(1, 1): 1, (2, 1): 1, (5, 1): 1, (3, 3): 2, (4, 4): 1, (6, 6): 1, (None, 7): 1, (7, 7): 1, (8, 8): 1})
    kept = near_copies.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 6, 7, 8]
    assert simhash.near_duplicates(empty).count() == near_copies.one_of_each(empty).count() == 0


def test_ids_play_no_part_in_what_is_linked(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[5]), (None, texts[5]), (None, texts[0])]
    kept = near_copies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) == Counter(rows[:6])


def test_buckets_find_all_links_of_any_radius():
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 30, np.uint64)
    values = np.array([s ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, int(rng.integers(0, 8)), replace=False))) for s in seeds for _ in range(12)], np.uint64)
    for radius in (0, 2, 4, 6, 9, 17):
        a, b = simhash.bucket_links(values, np.zeros(len(values), int), radius)
        root = roots([int(v) for v in values], radius)
        up = {int(x): int(y) for x, y in zip(a, b, strict=True)}
        assert len({up.get(int(v), int(v)) for v in values}) == len({int(values[r]) for r in root if True})


def test_planes_count_wide_distances():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 63, (300, 4), np.uint64)
    flips = np.packbits(rng.random((300, 256)) < rng.random((300, 1)) / 2, axis=1, bitorder="little").view(np.uint64)
    one, two = simhash.planes_of(a), simhash.planes_of(a ^ flips)
    far = np.bitwise_count(flips).sum(axis=1)
    wanted = rng.random(300) < 0.9
    for radius in (0, 5, 39, 80, 127, 255):
        found = simhash.near_lanes(lambda b: one[b : b + 8] ^ two[b : b + 8], 256, simhash.packed_lanes(wanted, one.shape[1]), radius)
        assert found.tolist() == np.flatnonzero(wanted & (far <= radius)).tolist()


def test_components(spark):
    r = random.Random(5)
    chain, thin, dense = [(i, i + 1) for i in range(300)], *([(r.randrange(n), r.randrange(n)) for _ in range(m)] for n, m in ((400, 260), (60, 40)))
    for edges in ([], [(1, 1)], [(5, 1), (5, 2)], chain, thin, dense, [(7, i) for i in range(100)] + [(i, 500 + i) for i in range(100)]):
        parent = {}

        def top(x):
            while parent.setdefault(x, x) != x:  # noqa: B023  called at once
                x = parent[x]  # noqa: B023
            return x

        for a, b in edges:
            if a != b:
                a, b = top(a), top(b)
                parent[max(a, b)] = min(a, b)
        got = [tuple(x) for x in components(spark.createDataFrame(edges, "a long, b long")).select("node", "root").collect()]
        assert sorted(got) == sorted((x, top(x)) for x in list(parent))


@pytest.mark.parametrize("chunk", [2048, 7])
def test_near_copies(spark, chunk, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(near_copies, "CHUNK", chunk)
    texts = []
    for n in (4, 5, 9, 30, 100, 300):
        for share in (0.01, 0.02, 0.03, 0.05, 0.1):
            words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            texts += [" ".join(words), " ".join(words[:-1])]
            texts += [" ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in words) for _ in range(4)]
    # A group whose members are all a little under and over the similarity from each other.
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts += [" ".join(f"x{rng.randrange(10**6)}" if rng.random() < 0.014 else w for w in words) for _ in range(60)]
    root = jaccard_roots(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for max_broadcast in (10**6, 0):
        assert sorted(r["doc_id"] for r in near_copies.one_of_each(docs, max_broadcast=max_broadcast).collect()) == sorted(set(root))
    assert 40 < len(set(root)) < len(texts) - 40


# 7. Quality rules


def test_quality_counts(docs, texts, odd, empty):
    for i, row in by_id(quality_rules.quality_report(docs)).items():
        words = re.findall("[^\x20\x09-\x0d]+", texts[i])
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        again = {k + d for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for d in range(5)}
        lines = [x for x in texts[i].split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", texts[i])), len(lines) - len(set(lines)), len(again), len(words) < 10 or 100 * len(again) > 20 * len(words))
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == expected
        assert not (row["kept"] and row["base_failed"])
    found = by_id(quality_rules.quality_report(odd))
    assert (found[1]["n_words"], found[1]["base_failed"], found[4]["n_repeat_words"]) == (0, True, 30_000)
    assert quality_rules.keep_good(odd).columns == odd.columns
    assert quality_rules.quality_report(empty).count() == quality_rules.keep_good(empty).count() == 0


def test_cascade_order_changes_no_verdict(docs):
    rules = quality_rules.BASE_RULES + quality_rules.METHOD_RULES
    assert {r.name for r in quality_rules.cascade_order(docs, rules)} == {r.name for r in rules}
    text = docs["text"]
    kept = [{r["doc_id"] for r in docs.where(quality_rules.verdict(text, order)).collect()} for order in (rules, rules[::-1])]
    assert kept[0] == kept[1] == {i for i, r in by_id(quality_rules.quality_report(docs)).items() if r["kept"]}


def test_order_follows_known_costs(spark, docs):
    """Rules whose work and rejection are known: one that does far more for no more, and one that rejects far more for the same."""
    Rule = quality_rules.Rule
    repeated = lambda t, n: F.aggregate(F.sequence(F.lit(1), F.lit(n)), F.lit(0).cast("long"), lambda acc, i: acc + F.length(F.sha2(F.concat(t, i.cast("string")), 256)))
    dear = Rule("dear", lambda t: repeated(t, 60) < 0)
    cheap_none = Rule("cheap_none", lambda t: F.char_length(t) < 0)
    cheap_half = Rule("cheap_half", lambda t: F.crc32(t.cast("binary")) % 2 == 0)
    for rules in ([dear, cheap_none, cheap_half], [cheap_half, dear, cheap_none]):
        order = [r.name for r in quality_rules.cascade_order(docs, rules)]
        assert order[0] == "cheap_half" and order[-1] == "dear"
    told = lambda sample, rules: [quality_rules.Rating(r, share, cost) for r, (share, cost) in zip(rules, [(0.1, 1.0), (0.5, 10.0), (0.4, 2.0)], strict=True)]
    assert [r.name for r in quality_rules.cascade_order(docs, [dear, cheap_none, cheap_half], rated=told)] == ["cheap_half", "dear", "cheap_none"]


def test_sample_is_bounded_and_from_all_of_the_table(spark):
    table = spark.createDataFrame([(i, f"text {i} " * (9000 if i == 5 else 1)) for i in range(500)] + [(0, None)], "doc_id long, text string")
    rows = [r["text"] for r in quality_rules.sampled(table, sample_rows=100, max_chars=50).collect()]
    assert len(rows) == 100 and max(map(len, rows)) <= 50
    assert sum(int(t.split()[1]) >= 250 for t in rows if t) > 30
    assert quality_rules.sampled(table.repartition(7), sample_rows=100, max_chars=50).collect() == [(t,) for t in rows]


# 8. Token shards


def test_token_shards(docs, texts, odd, empty, spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORDS)
    shards = token_shards.write_shards(docs, WORDS)
    found, start = by_id(token_shards.read_shards(shards)), 0
    for i in sorted(texts):
        ids = np.array([*model.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        assert tuple(found[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    wanted = spark.createDataFrame([(5,), (17,), (10**12,)], "doc_id long")
    got = {r["doc_id"]: r["ids"] for r in token_shards.lookup(shards, wanted).collect()}
    assert set(got) == {5, 17} and list(np.frombuffer(got[5], "<u4")) == [*model.encode(texts[5], add_special_tokens=False).ids, 1]
    assert token_shards.shard_report(odd, WORDS).count() == len(ODD)
    assert token_shards.shard_report(empty, WORDS).count() == 0


def test_lookup_of_ids_that_several_shards_hold(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} of some words") for i in range(900)] + [(5, None)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = token_shards.write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), WORDS)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert shards.where("low <= 7 AND high >= 7").count() > 1
    assert shards.agg({"n_docs": "max"}).collect()[0][0] < 500
    code = token_shards.Coder(WORDS)
    wanted = [(7,), (5,), (None,), (2,), (10**15,), (7,)]
    found = Counter((r["doc_id"], bytes(r["ids"])) for r in token_shards.lookup(shards, spark.createDataFrame(wanted, "k long"), "k").collect())
    ids = lambda t: np.append(np.frombuffer(code.encode([t])[0], code.type), 1).astype("<u4").tobytes()
    assert found == Counter((i, ids(t or "")) for i, t in rows if (i,) in wanted)


def test_other_tokenizers_encode_whole_texts(tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    code, model = token_shards.Coder(path), Tokenizer.from_file(path)
    texts = ["Two words  and\nlines", "", "É <|endoftext|> 漢"]
    assert not code.by_word and token_shards.drops_white_space(WORDS)
    assert [np.frombuffer(x, code.type).tolist() for x in code.encode(texts)] == [model.encode(t, add_special_tokens=False).ids for t in texts]
    told = json.load(open(WORDS))
    told["normalizer"]["normalizers"].pop()
    (tmp_path / "kept-case.json").write_text(json.dumps(told))
    assert not token_shards.drops_white_space(str(tmp_path / "kept-case.json"))


def test_words_are_encoded_as_whole_texts_are():
    code, rng = token_shards.Coder(WORDS), random.Random(2)
    pieces = ["a", "a,", "B!?", "É.", "é", " ", "\n", "'s", "ß", "İ", "Σ", "1", "!", "́", "\t", "\x1c", " ", "漢", "🎉", "<|endoftext|>", "\x85"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(code.encode([text])[0], code.type).tolist() == code.model.encode(text, add_special_tokens=False).ids


def test_special_token_strings_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    model, code, rng = Tokenizer.from_file(WORDS), token_shards.Coder(WORDS), random.Random(7)
    assert np.frombuffer(code.encode(["first part <|endoftext|> second"])[0], code.type).tolist() == [874, 1551, 49407, 2241]
    pieces = ["a", "ab,", "É", " ", "\n", "!", "<|startoftext|>", "<|endoftext|>", "<|", "|>", "<|ENDOFTEXT|>", "漢", "'s"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(code.encode([text])[0], code.type).tolist() == model.encode(text, add_special_tokens=False).ids


def test_perfect_hash():
    keys = token_shards.key_hashes([*range(5000), None])
    index = token_shards.PerfectHash.of(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(5001))
    assert token_shards.PerfectHash.of(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


# 9. Attention


def test_attention_scores_held_out_documents(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.01"), documents(spark, "/root/testdata/sf0.01", "labels")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    found = [r for r in attention_mil.quality_scores(docs, labels).collect() if r["held_out"] and r["doc_id"] in known]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 for r in found)
    assert sum(r["predicted"] == known[r["doc_id"]] for r in found) >= 0.95 * len(found)


def test_attention_is_fitted_on_whole_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(attention_mil, "fit", lambda x, owner, labels: seen.append(np.bincount(owner).tolist()))
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:2]
    docs = spark.createDataFrame([(ids[0], "some word " * 10_000), (ids[1], "a short text")], "doc_id long, text string")
    attention_mil.train(docs, spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int"))
    assert seen == [[400, 1]]


def test_attention_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 0, 1), (6, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert attention_mil.quality_scores(odd, labels).count() == len(ODD)
    assert attention_mil.quality_scores(empty, labels).count() == 0
    assert {r["score"] for r in attention_mil.quality_scores(odd, labels.where("false")).collect()} == {0.5}


def test_several_texts_of_one_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(attention_mil, "fit", lambda x, owner, labels: seen.append(x.tolist()))
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:2]
    rows = [(ids[0], "one text of it"), (ids[0], "And ANOTHER one! 12"), (ids[0], None), (ids[1], "a short text")]
    labels = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "doc_id long, quality int")
    for n in (1, 3):
        attention_mil.train(spark.createDataFrame(rows[:: 1 if n == 1 else -1], "doc_id long, text string").repartition(n), labels)
    assert seen[0] == seen[1] and len(seen[0]) == 2


def test_forward_pass_equals_plain_loops():
    rng = np.random.default_rng(3)
    labels = np.array([0, 1, 1, 0.0])
    owner = np.repeat(np.arange(4), [2, 1, 4, 3])
    features = rng.normal(size=(10, attention_mil.N_FEATURES))
    model = attention_mil.fit(features, owner, labels, rounds=5)
    w = model.weights
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    dot = lambda x, m: [sum(x[i] * m[i, j] for i in range(len(x))) for j in range(m.shape[1])]
    for bag, score in enumerate(model.score(features, owner, 4)):
        coded, raw = [], []
        for row in features[owner == bag]:
            x = [(v - m) / s for v, m, s in zip(row, model.mean, model.spread, strict=True)]
            h = [math.tanh(v + b) for v, b in zip(dot(x, w["encode"]), w["encode0"], strict=True)]
            told, gate = [math.tanh(v) for v in dot(h, w["tell"])], [sigmoid(v) for v in dot(h, w["gate"])]
            coded.append(h)
            raw.append(math.exp(sum(t * g * a for t, g, a in zip(told, gate, w["attend"], strict=True))))
        mean = [sum(r * h[i] for r, h in zip(raw, coded, strict=True)) / sum(raw) for i in range(len(coded[0]))]
        assert abs(score - sigmoid(sum(m * v for m, v in zip(mean, w["score"], strict=True)) + w["score0"][0])) < 1e-12


def test_words_reach_the_features():
    import pyarrow as pa

    one, two = (attention_mil.passages(pa.array([t]))[0] for t in ("good words here", "poor terms here"))
    assert not np.allclose(one[0, -attention_mil.BUCKETS :], two[0, -attention_mil.BUCKETS :])
    assert abs(one[0, -attention_mil.BUCKETS :].sum() - 1) < 1e-12


def test_gradients():
    rng = np.random.default_rng(0)
    owner = np.repeat(np.arange(6), [1, 3, 2, 4, 1, 2])
    features, labels = rng.normal(size=(13, attention_mil.N_FEATURES)), np.array([0, 1, 0, 1, 1, 0.0])
    loss = lambda m: -np.mean(labels * np.log(m.score(features, owner, 6)) + (1 - labels) * np.log(1 - m.score(features, owner, 6)))
    assert loss(attention_mil.fit(features, owner, labels, rounds=60)) < 0.2 * loss(attention_mil.fit(features, owner, labels, rounds=1))


# 10. Decontamination


def test_contamination(docs, texts, spark, sf):
    bench = documents(spark, sf, "benchmark")
    expected = multiset(brute_matches(texts.items(), [tuple(r) for r in bench.collect()]))
    assert multiset(map(tuple, suffixes.contamination_report(docs, bench).collect())) == expected
    assert multiset(map(tuple, suffixes.contamination_report(docs, bench, block_bytes=3000).collect())) == expected


def test_contamination_of_odd_rows(odd, empty, spark):
    items = [(1, "just A few"), (1, "long long"), (22, None), (3, ""), (4, "Ünï¢ødé ŧëxt"), (5, "but a text of several words and a second sentence follows it"), (6, "漢字")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert multiset(map(tuple, suffixes.contamination_report(odd, bench).collect())) == multiset(brute_matches(ODD, items))
    clean = suffixes.decontaminated(odd, bench)
    assert clean.columns == odd.columns and sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 5, 8]
    assert suffixes.contamination_report(empty, bench).count() == 0
    assert suffixes.contamination_report(odd, bench.where("false")).where("contaminated").count() == 0


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "x y a b c d e f g h i j k l z"), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "q a b c d e f g h i j k l r")], "item_id long, text string")
    assert [tuple(r) for r in suffixes.longest_matches(docs, bench).collect()] == [(1, "7", 1, 2, 12)]
