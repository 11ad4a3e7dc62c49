"""Repeats, collocations and source divergence against plain versions and their SQL twins."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from helixframe.llm import collocations, divergence, queries, repeats

SF = "/root/testdata/sf0.001"
DDL = "doc_id bigint, text string, lang string, source string, term string, n bigint, row string, anchor string"


def frame(spark, rows):
    """(doc_id, text, lang, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, "y", None) for r in rows], DDL)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    n, mine, theirs = oracle.differences(spark, SF, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert not mine and not theirs, (mine, theirs)
    assert n > 0


# ---------------------------------------------------------------- repeats


def plain_repeats(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[s : s + length] for r in raws for s in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, x in zip(r, gone, strict=True) if not x)).hexdigest()))
    return out


def odd_texts():
    """Runs, short periods, shared passages, bytes of zero, letters of several bytes, equal texts, lengths about 200."""
    rng, base = np.random.default_rng(1), np.random.default_rng(5).choice(list("abcdé "), 2000)
    makes = [
        lambda: "x" * int(rng.integers(1, 900)), lambda: "ab" * int(rng.integers(1, 300)), lambda: f"{7:050d}" * int(rng.integers(1, 8)), lambda: "\0" * int(rng.integers(1, 300)),
        lambda: "".join(base[(a := int(rng.integers(0, 1500))) : a + int(rng.integers(150, 500))]), *[lambda: "".join(rng.choice(list("abc\n漢"), int(rng.integers(1, 400))))] * 3,
    ]
    texts = ["".join(makes[int(rng.integers(0, len(makes)))]() for _ in range(int(rng.integers(1, 9)))) for _ in range(120)]
    return [*texts, None, "", texts[3], texts[4], f"{texts[4]}z", "x" * 5000, "q" * 199, "q" * 200, "r" * 200, "r" * 200, "s" * 201]


@pytest.mark.parametrize("many", [repeats.MANY, 1])
def test_repeats_equal_plain_search(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)  # with 1, every anchor with two contexts is split by whole strings
    texts = odd_texts()
    docs = frame(spark, [(None if k == 5 else k % 130, t, None, None) for k, t in enumerate(texts)])
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.h) for r in repeats.remove_repeats(docs).withColumn("h", F.sha2("kept", 256)).collect()]
    want = [(None if k == 5 else k % 130, *w) for k, w in enumerate(plain_repeats(texts))]
    assert Counter(got) == Counter(want)


def test_repeats_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], plain_repeats([d.text for d in docs]), strict=True))
    got = queries.op11_suffix_dedup(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want and sum(w[1] for w in want.values()) > 0


def test_repeats_many_texts_with_one_line(spark, monkeypatch):
    """One line of 150 bytes in all texts is no repeat; one of 260 is, among any surroundings."""
    monkeypatch.setattr(repeats, "MANY", 20)
    rng = np.random.default_rng(3)
    noise = lambda: "".join(rng.choice(list("abcdefgh "), 400))
    short, line = "".join(rng.choice(list("mnopq"), 150)), "".join(rng.choice(list("rstuv"), 260))
    texts = [noise() + (short if k % 2 else line) + noise() for k in range(100)]
    got = repeats.remove_repeats(frame(spark, [(k, t, None, None) for k, t in enumerate(texts)])).collect()
    want = plain_repeats(texts)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got} == {k: w[:3] for k, w in enumerate(want)}
    assert all((260 <= w[1] < 280) == (k % 2 == 0) for k, w in enumerate(want))  # neighbours of the line may be equal by chance


def test_runs_of_parts_and_of_equal_strings():
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 4, 4000).astype(np.uint8)
    raw[3000:3500], raw[1000:1600] = raw[100:600], 7

    def keys(part):
        kept, repeats.PART = repeats.PART, part
        try:
            found = [x.tolist() for x in repeats.runs_of(raw, 200)[:3]]
        finally:
            repeats.PART = kept
        return {s: k for k, a, b in zip(*found, strict=True) for s in range(a, b)}

    whole = keys(2_000_000)
    assert sorted(whole) == list(range(3801)) and whole == keys(333)
    assert [whole[s] for s in range(100, 401)] == [whole[s] for s in range(3000, 3301)]


def test_suffix_order():
    rng = np.random.default_rng(2)
    for _ in range(300):
        raw = rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(0, 200))).astype(np.uint8) * 100
        blob = raw.tobytes()
        order = sorted(range(len(raw)), key=lambda k: blob[k:])  # noqa: B023
        assert repeats.suffix_order(raw, len(raw) + 8).tolist() == order
        wanted = rng.random(len(raw)) < rng.random()
        assert repeats.suffix_order(raw, len(raw) + 8, wanted).tolist() == [k for k in order if wanted[k]]


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert repeats.remove_repeats(docs).count() == collocations.mine(docs).count() == divergence.audit(docs).count() == 0


# ---------------------------------------------------------------- collocations


def plain_collocations(rows, least, ranks):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        mine = []
        for p, a in counts.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and b >= least and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in counts.items()):
                continue
            s, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            mine.append((-s, -a, " ".join(p).encode(), left, right))
        for k, (s, a, p, left, right) in enumerate(sorted(mine)[:ranks]):
            out.append((lang, k + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def words_rows():
    rng = np.random.default_rng(4)
    words = ["a", "B", "b", "c", "dé", "DÉ", "\xa0", "x,y", "e.", "f\n", "g\x0b", "\tq", "漢", "z" * 40]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(0, 60)))), [None, "und", "en", "fr", ""][k % 5], None) for k in range(150)]
    return [*rows, rows[3], rows[3], (None, None, "en", None), (9, "", None, None), (1, "a b c " * 3000, "en", None), (2, "only in one lang here", "xx", None)]


@pytest.mark.parametrize("ranks", [2000, 7])
def test_collocations_equal_plain_counts(spark, ranks):
    rows = words_rows()
    got = collocations.mine(frame(spark, rows), least=10, ranks=ranks)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 10, ranks)


def test_trie_bursts_and_spills():
    rng = np.random.default_rng(0)
    first, second, third = (rng.integers(1, 30, 20_000) for _ in range(3))
    trie = collocations.HatTrie(31, burst=20, full=3_000)
    for at in range(0, 20_000, 1_500):
        trie.add(first[at : at + 1_500], second[at : at + 1_500] * 31 + third[at : at + 1_500])
    assert len(trie.runs) > 2 and trie.levels  # subtrees were spilled before the end
    total = Counter()
    for run in trie.drain():
        keys = list(zip(*(x.tolist() for x in run[:2]), strict=True))
        assert keys == sorted(set(keys))
        for (w, r), n in zip(keys, run[2].tolist(), strict=True):
            total[w, r // 31, r % 31] += n
    assert total == Counter(zip(first.tolist(), second.tolist(), third.tolist(), strict=True)) and not trie.entries


def test_runs_pack_and_merge():
    wide = np.array([[5, 5, 1 << 40], [2, 2, 3], [0, 0, 9], [4, 6, 1]])
    assert np.array_equal(collocations._unpack_run(collocations._pack_run(*wide)), wide)
    assert collocations._added(wide).tolist() == [[5, 1 << 40], [2, 3], [0, 9], [10, 1]]


def test_score_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**14 - 1, 10**14, 10**14 + 7)], "a bigint, l bigint, r bigint")
    a, left, right = 10**14 - 1, 10**14, 10**14 + 7
    assert row.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)


# ---------------------------------------------------------------- divergence


def plain_divergence(rows, least, ranks):
    docs, n = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for _, _, lang, source in rows}
    for _, text, lang, source in rows:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        docs[lang or ""].update(set(words))
        n[lang or "", source or ""].update(words)
    kept = {lang: {w for w, k in c.items() if k >= least} for lang, c in docs.items()}

    def shares(counts, lang):
        total, v = sum(counts[w] for w in kept[lang]), len(kept[lang])
        return {w: 1 + 10**9 * (counts[w] + 5) // (total + 5 * v) for w in kept[lang]}

    whole = {lang: shares(sum((n[g] for g in groups if g[0] == lang), Counter()), lang) for lang in kept}
    own = {g: shares(n[g], g[0]) for g in groups}
    out = []
    for lang, source in groups:
        p = own[lang, source]
        pairs = [(-sum(abs(p[w] - own[lang, other][w]) for w in p), other.encode()) for k, other in groups if k == lang and other != source]
        terms = [(whole[lang][w] - p[w], w.encode()) for w in p if n[lang, source][w] and p[w] > whole[lang][w]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
            out += [(lang, source, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("ranks", [50, 3])
def test_divergence_equals_plain_counts(spark, ranks):
    rng = np.random.default_rng(6)
    words = ["a", "B", "b", "Cé", "cÉ", "漢", "x1y", "d_e", "\xa0", *(f"{p}{q}" for p in "klmn" for q in "opqrs")]
    sources = [None, "", "s1", "s2", "s3", "é", "Z"]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(0, 40)))), ["en", "fr", None, ""][k % 4], sources[int(rng.integers(0, 7))]) for k in range(300)]
    rows += [rows[3], rows[3], (None, None, "en", "empty"), (1, "rare", "xx", "a"), (1, "rare", "xx", "b"), (5, "k o " * 3000, "fr", "s1")]
    got = divergence.audit(frame(spark, rows), least_docs=12, ranks=ranks)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and [t for _, t in got.dtypes[4:]] == ["bigint", "int"]
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, 12, ranks)


def test_divergence_ties_in_byte_order(spark):
    """More terms of one value than ranks: the first in UTF-8 order stay."""
    terms = [f"t{k}x" for k in "abcdefghij"] + ["é", "z"]
    rows = [(k, " ".join(terms), "en", "one") for k in range(3)] + [(9, "other " * 9, "en", "two")] * 3
    got = divergence.audit(frame(spark, rows), least_docs=2, ranks=5)
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, 2, 5)
