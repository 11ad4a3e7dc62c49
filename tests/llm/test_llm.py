"""Corpus operators against plain versions, exact round trips and held-out rows."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm import bpe, embeddings, graph, langid, minhash, neighbours, packing, pages, pii, quality, queries, toxicity

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "a  b \n c\t", "x" * 5000, "é́ß 漢字 \x1c   <|endoftext|> it's", "word " * 3000, "\n\n \n"]


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, a null key, and a clashing extra column."""
    rows = [(k, t, None, None, None, "x") for k, t in enumerate(ODD)] + [(3, "a", None, None, None, "y"), (None, "lost key", "en", "s", 8, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---------------------------------------------------------------- PII


def plain_spans(text):
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub(r"\D", "", s)) <= 19 and pii.luhn(re.sub(r"\D", "", s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub(r"\D", "", s)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in tests.items() for m in re.finditer(p, text) if ok(m[0])]


PII_TEXTS = [
    "a@b.co c@d.e.f@g.h x@@y.z @q.r m+n%o@p-q.rs. tail@", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111-1",
    "+1 (555) 010-9999 +12 +1 2 3 4 5 6 7 8 9 +123456789 (x) +1.1.1.1.1.1.1.1.1", "call +44 20 7946 0958, ip 10.0.0.1 card 5500005555555559 mail a.b@c.de",
]


@pytest.mark.parametrize("text", PII_TEXTS)
def test_base_spans(text):
    assert [(s.kind, s.start, s.end) for s in pii.spans_of(text) if s.kind in pii.BASE_KINDS] == plain_spans(text)


def test_numbers_with_many_leading_zeros():
    text = "0" * 5000 + "1.1.1.1 and " + "9" * 5000 + ".1.1.1.1"
    assert [(s.start, s.end) for s in pii.spans_of(text) if s.kind == "ip"] == [(0, 5007)]


def test_base_spans_of_random_texts():
    rng = np.random.default_rng(0)
    for _ in range(300):
        text = "".join(rng.choice(list("0123456789.+@- ()ab,"), 120))
        assert [(s.kind, s.start, s.end) for s in pii.spans_of(text) if s.kind in pii.BASE_KINDS] == plain_spans(text)


def test_added_spans_and_redaction():
    text = "my IBAN account GB82 WEST 1234 5698 7654 32 ok, ssn 123-45-6789"
    assert {s.kind for s in pii.spans_of(text)} >= {"iban", "ssn"}
    assert "6789" not in pii.redacted(text, pii.spans_of(text)) and "7654 32" not in pii.redacted(text, pii.spans_of(text))
    assert not [s for s in pii.spans_of("GB82 WEST 1234 5698 7654 33") if s.kind == "iban"]


def test_ibans_by_country_and_what_follows_them():
    for text in ("IBAN GB82 WEST 1234 5698 7654 32 OK", "GB82WEST12345698765432 BIC NWBKGB2L", "(DE89370400440532013000)"):
        found = [s for s in pii.spans_of(text) if s.kind == "iban"]
        assert len(found) == 1 and text[found[0].start : found[0].end].replace(" ", "") in ("GB82WEST12345698765432", "DE89370400440532013000")
    assert not [s for s in pii.spans_of("XX82 WEST 1234 5698 7654 32 DE8937040044053201300") if s.kind == "iban"]


def test_secrets_and_context_that_lowers():
    text = 'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y'
    assert [(s.kind, text[s.start : s.end]) for s in pii.spans_of(text)] == [("secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962")]
    assert "04db" not in pii.redacted(text, pii.spans_of(text)) and not pii.spans_of("token of thanks: nothing")
    assert not [s for s in pii.spans_of("serial part order 123-45-6789") if s.kind == "ssn"] and [s for s in pii.spans_of("social security 123-45-6789") if s.kind == "ssn"]
    plain, doubtful = (pii.spans_of(t)[0] for t in ("at 10.1.2.3", "version 10.1.2.3"))
    assert plain.kind == doubtful.kind == "ip" and plain.score > doubtful.score


def test_pii_frames(spark):
    out = pii.pii_digest(odd_documents(spark)).collect()
    assert len(out) == len(ODD) + 2 and {r.spans for r in out} == {""}
    masked = pii.redact_pii(odd_documents(spark))
    assert masked.columns == odd_documents(spark).columns and masked.where("text is null").count() == 1
    assert pii.pii_digest(odd_documents(spark).where("false")).count() == 0


# ---------------------------------------------------------------- tokens


def plain_bpe():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ranks, tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark):
    ranks, encoding = plain_bpe()
    rows = odd_documents(spark).select("doc_id", "text").unionByName(documents(spark).where("doc_id < 60").select(F.col("doc_id") + 100, "text").toDF("doc_id", "text"))
    texts = {(r.doc_id): r.text or "" for r in rows.collect()}
    got = bpe.decode(bpe.encode(rows, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows.collect())
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == encoding.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) // 4
        assert bytes(r.decoded).decode() == texts[r.doc_id]
    assert bpe.encode(rows.where("false"), ranks, public_tokenizers.PATTERN).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        given = f.read()
    plain = Tokenizer.from_str(given)
    rows = odd_documents(spark).where("doc_id is null or doc_id <> 3").select("doc_id", "text").unionByName(documents(spark).where("doc_id between 100 and 180").select("doc_id", "text"))
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    got = packing.pack(rows, given).collect()
    held, pieces = {}, {}
    for r in got:
        ids = plain.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]
        part = ids[r.start : r.start + r.length]
        assert np.frombuffer(r.ids, "<u4").tolist() == part and zlib.crc32(r.ids) == r.ids_crc32 and r.doc_tokens == len(ids) and len(part) == r.length
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
    assert set(pieces) == set(texts) and sorted(held) == list(range(len(held)))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(rows.where("false"), given).count() == 0


def test_patterns_meet_demand():
    rng = np.random.default_rng(3)
    lengths = sorted(Counter((np.minimum(rng.exponential(150, 3000), 511).astype(int) + 1).tolist()).items())
    patterns = packing.solve(lengths, 2048)
    made = Counter()
    for classes, copies in patterns:
        assert sum(classes) <= 512
        for c in classes:
            made[c] += copies
    assert made == Counter(dict(lengths))
    least = -(-sum(c * n for c, n in lengths) // 512)
    assert sum(n for _, n in patterns) <= 1.02 * least + 1


def test_elimination():
    a = np.random.default_rng(8).integers(0, 5, (40, 40)).astype(float)
    assert np.allclose(packing.inverted(a) @ a, np.eye(40)) and packing.inverted(np.ones((3, 3))) is None


def test_words_are_let_go_of(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    monkeypatch.setattr(packing, "CACHE_PARTS", 20)
    monkeypatch.setattr(packing, "TOGETHER", 7)
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        given = f.read()
    words, plain, rng = packing.Words(given), Tokenizer.from_str(given), np.random.default_rng(3)
    vocabulary = ["Word" + "".join(rng.choice(list("abcé"), 4)) + sign for sign in ("", ".", "!?", "'s", "-x", "9") for _ in range(20)]
    for _ in range(30):
        texts = [" ".join(rng.choice(vocabulary, 15)) for _ in range(3)]
        assert [np.frombuffer(i, "<u4").tolist() for i in words.ids(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(words.raw) + len(words.raw.old) < 120


def test_knapsack():
    rng = np.random.default_rng(1)
    sizes, values = rng.integers(1, 12, 6), rng.random(6)
    best, taken = packing.knapsack(values, sizes, 30)
    worth = [0.0] * 31
    for w in range(1, 31):
        worth[w] = max([worth[w - 1], *(worth[w - s] + v for s, v in zip(sizes, values) if s <= w)])
    assert best == pytest.approx(worth[30]) and taken @ values == pytest.approx(best) and taken @ sizes <= 30


# ---------------------------------------------------------------- classifiers


def test_language(spark):
    got = queries.op5_language(spark, SF).join(documents(spark), "doc_id")
    right, n = got.where("held_out and length(text) > 40").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.95 and n > 20
    model = langid.learn({"aa": "abab abba baab" * 20, "bb": "cdcd dccd ccdd" * 20})
    out = {r.doc_id: r.lang_pred for r in langid.identify(odd_documents(spark), model).collect()}
    assert out[0] == out[1] == out[2] == "und"
    assert langid.predict(["abba abab", "cdcd", "123"], model)[0] == ["aa", "bb", "und"]
    assert langid.identify(odd_documents(spark), langid.learn({})).where("lang_pred <> 'und'").count() == 0


def test_languages_of_many_letters():
    rng = np.random.default_rng(6)
    scripts = {"aa": range(0x4E00, 0x4E00 + 400), "bb": range(0x5E00, 0x5E00 + 400), "cc": range(0xAC00, 0xAC00 + 400)}
    samples = {k: "".join(chr(c) for c in rng.choice(list(own), 3000)) for k, own in scripts.items()}
    model = langid.learn(samples | {"dd": "plain latin text"})
    texts = [samples["aa"][50:90], samples["bb"][50:90], samples["cc"][50:90], "latin text"]
    assert langid.predict(texts, model)[0] == ["aa", "bb", "cc", "dd"]
    assert langid.phrases([langid.letters(t, model.codes) for t in texts], model).min(axis=1).tolist() == [1, 1, 1, 1]


def test_phrases_are_longest_matches():
    model = langid.learn({"aa": "the cat sat on the mat", "bb": "dog eats frog"})

    def plain(text, sample):
        text, sample, n, at = " ".join(re.findall("[a-z]+", text)), " ".join(re.findall("[a-z]+", sample)), 0, 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in sample:
                size += 1
            at, n = at + size, n + 1
        return n

    for text in ("the cat eats the frog", "frogmat", "zebra on the dog", "t"):
        found = langid.phrases([langid.letters(text, model.codes)], model)[0]
        assert found.tolist() == [plain(text, "the cat sat on the mat"), plain(text, "dog eats frog")]


def test_toxicity():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdeilmnorst"), 5)) for _ in range(150)]

    def text(bad):
        own = list(rng.choice(words, 80))
        return " ".join(own + list(rng.choice(bad, 4)) if bad else own)

    texts = [text(["grumpkin", "snarfel"] if k % 4 == 0 else None) for k in range(400)]
    model = toxicity.learn(texts, [int(k % 4 == 0) for k in range(400)])
    scores = toxicity.Scorer(model).scores([text(["grumpkin"]), text(None), text(["grumpkins", "snarfell"]), ""])
    assert scores[0] > 0.5 > scores[1] and scores[2] > 0.5 and 0 <= scores[3] <= 1
    assert toxicity.Scorer(toxicity.learn([], [])).scores(["x"]).tolist() == [0.0]


def test_toxicity_by_a_plain_version():
    """A word is the mean over its subwords, a stretch the mean of its words, a text its stretches' softmax average and the bias."""
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), 0.3, 0.7, -0.2, 0.1)

    def plain(text):
        parts = []
        for token in toxicity.tokens_of(text):
            words = re.findall(r"\w+", token)
            if words:
                parts.append(np.mean([np.mean([float(model.weights[g]) for g in toxicity.subwords([w])[1]]) for w in words]))
        if not parts:
            return model.prior
        size = min(toxicity.WINDOW, len(parts))
        odds = np.array([sum(parts[k : k + size]) / toxicity.WINDOW for k in range(len(parts) - size + 1)])
        share = np.exp(toxicity.SHARPNESS * odds) / np.exp(toxicity.SHARPNESS * odds).sum()
        return 1 / (1 + np.exp(-(model.scale * (share @ odds + model.bias) + model.shift)))

    texts = ["One two, three four five six?", "a", "", " .. ", "it's it's half-done", "x y " * 30]
    assert np.allclose(toxicity.Scorer(model).scores(texts), [plain(t) for t in texts], atol=1e-6)


def test_toxicity_frames(spark):
    model = toxicity.learn(["good day to all"] * 9 + ["vile scum here now"] * 9, [0] * 9 + [1] * 9)
    rows = odd_documents(spark)
    got = toxicity.score(rows, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows.collect()) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (0, 1, 2)} == {model.prior if model.constant is None else model.constant}
    assert toxicity.score(rows.where("false"), model).count() == 0
    assert toxicity.add_score(rows, model, name="other").columns == [*rows.columns, "other"]


def test_quality_by_a_plain_version():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["fine", "calm", "clear"] if k % 2 else ["BAD!!", "x9x9", "$$$"], 12)) for k in range(60)]
    labels = [k % 2 for k in range(60)]
    model = quality.learn(texts[:50], labels[:50])
    x = quality._weighted(quality.Features().counts(texts), model.idf).astype(float)
    _, _, right = np.linalg.svd(x[:50], full_matrices=False)
    full = x @ right[: quality.DIMS].T
    unit = full / np.maximum(np.linalg.norm(full, axis=1, keepdims=True), 1e-12)
    want = []
    for row in unit[50:] @ unit[:50].T:
        top = np.argsort(-row, kind="stable")[:7]
        weight = np.maximum(row[top], 0)
        want.append(weight @ np.array(labels)[top] / weight.sum())
    got = quality.Scorer(model).scores(texts[50:])
    assert ((got >= 0.5) == (np.array(want) >= 0.5)).all() and np.abs(got - want).max() < 0.2


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality").where("quality is not null")
    rows = queries.op8_quality(spark, "/root/testdata/sf0.01").where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = queries.op8_quality(spark, SF).join(labels, "doc_id").where("quality is not null")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.9
    model = quality.learn(["good words here"] * 3 + ["BAD!! BAD!!"] * 3, [1, 1, 1, 0, 0, 0])
    assert quality.Scorer(model).scores([""]).tolist() == [0.5]
    assert len(quality.score(odd_documents(spark), model).collect()) == len(ODD) + 2
    assert quality.Scorer(quality.learn([], [])).scores(["x"]).tolist() == [0.0]


# ---------------------------------------------------------------- vectors


def vector_rows(spark, n=400, hot=60):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=16)
    x = np.concatenate([rng.normal(size=(n, 16)), centre + 0.05 * rng.normal(size=(hot, 16))]).astype(np.float32).astype(float)
    rows = [(k, v.tolist(), None) for k, v in enumerate(x)] + [(n + hot + k, x[0].tolist(), None) for k in range(5)]
    base = n + hot + 5
    rows += [(base, None, 1), (base + 1, [0.0] * 16, 1), (base + 2, [float("nan")] + [1.0] * 15, 1), (base + 3, [None] + [1.0] * 15, 1)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]))


def plain_vectors(df):
    rows = df.orderBy("vec_id").collect()
    ok = [r for r in rows if r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding) and any(r.embedding)]
    return rows, np.array([r.vec_id for r in ok]), np.array([r.embedding for r in ok], float)


def test_embedding_links(spark):
    df = vector_rows(spark)
    rows, ids, x = plain_vectors(df)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    label = ids.copy()
    for _ in range(50):
        label = np.minimum(label, np.where(linked, label[None, :], 10**9).min(axis=1))
    want = {i: (int(d), int(c)) for i, d, c in zip(ids.tolist(), linked.sum(axis=1), label)} | {r.vec_id: (0, r.vec_id) for r in rows if r.vec_id not in set(ids.tolist())}
    got = embeddings.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_embedding_passes_grow_with_rows():
    for rows in (1, 384, 50_000, 600_000, 3_000_000, 50_000_000):
        meets = (1 - np.arccos(0.9) / np.pi) ** np.log2(max(rows / 384, 1))
        assert (1 - meets) ** embeddings.passes_for(rows, 0.9) <= 0.002
    assert embeddings.passes_for(10_000, 0.9) == 16 < embeddings.passes_for(600_000, 0.9) < embeddings.passes_for(3_000_000, 0.9)


def test_embedding_windows_go_on_over_batches(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(200, 16))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {int(k) for k in np.flatnonzero(((u @ u.T) >= 0.6).sum(axis=1) > 1)}
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "class bigint, vector array<double>")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        found = {v for r in embeddings.pass_links(rows, 0.6).collect() for v in (r.a, r.b)}
    finally:
        spark.conf.set(name, before)
    assert found == want and len(want) > 20


def test_neighbours(spark):
    df = vector_rows(spark)
    _, ids, x = plain_vectors(df)
    found = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = n = 0
    for q, at in ((q, k) for k, q in enumerate(ids.tolist()) if q % 20 == 0):
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        d[at] = np.inf
        best = ids[np.lexsort((ids, d))[:10]].tolist()
        assert sorted(found[q]) == list(range(1, 11))
        hits += len(set(best) & {v for v, _ in found[q].values()})
        n += 10
        assert all(abs(d[ids.tolist().index(v)] - s) < 1e-12 for v, s in found[q].values())
    assert hits / n >= 0.9
    few = df.where("vec_id < 3")
    assert neighbours.nearest(few, F.lit(True), k=10).count() == 6 and neighbours.nearest(df.where("false"), F.lit(True)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(1000 + k, 1001 + k) for k in range(40)]
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {v: find(v) for e in edges if e[0] != e[1] for v in e}
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want


# ---------------------------------------------------------------- near copies


def plain_classes(texts, known):
    sh, features = minhash.Shingler(), {}
    for k, t in texts.items():
        s, n, _ = sh([t or ""])
        if len(s):
            features[k] = s.tobytes() + (n * known.of(s)).astype("<f4").tobytes()
    label = {k: k for k in texts}
    keys = sorted(features)
    changed = True
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if minhash.similarity(features[a], features[b]) >= minhash.THRESHOLD]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def near_texts():
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(300)]
    texts, base = {}, [str(w) for w in rng.choice(words, 120)]
    for k in range(40):  # a chain of edits: neighbours are near, ends are not
        base = [*base]
        base[int(rng.integers(120))] = f"edit{k}"
        texts[k] = " ".join(base)
    for k in range(40, 70):
        texts[k] = " ".join(rng.choice(words, 60))
    return texts | {70: texts[0], 71: texts[0].upper() + " !!", 72: "", 73: None, 74: "one two", 75: "one two"}


def test_near_copies(spark):
    texts = near_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    assert got == plain_classes(texts, minhash.weights(df))
    assert minhash.near_duplicates(df.where("false")).count() == 0
    assert len(minhash.near_duplicates(odd_documents(spark)).collect()) == len(ODD) + 2


def test_near_copies_in_a_group_of_a_third(spark):
    """Copies at plain similarities of 0.81 to 0.9 from the first, which others hold a third of all rows with."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(2000)]
    base = [str(w) for w in rng.choice(words, 100)]
    texts = {0: " ".join(base)}
    for k in range(1, 40):
        own = [*base]
        own[30] = f"edit{k}"
        if k % 2:
            own[60] = f"other{k}"
        texts[k] = " ".join(own)
    texts |= {k: " ".join(rng.choice(words, 100)) for k in range(40, 120)}
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert got == {k: 0 if k < 40 else k for k in texts}


def test_near_copies_that_share_less_with_each_other(spark):
    """Each at a plain similarity of 0.81 to the first, and of 0.66 to most others: all but one are left out of the counts of what they share."""
    rng = np.random.default_rng(14)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(5000)]
    base = [str(w) for w in rng.choice(words, 150)]
    texts = {0: " ".join(base)}
    for k in range(1, 150):
        own = [*base]
        for at in range(5 + k % 40, 150, 50)[:3]:
            own[at] = f"edit{k}x{at}"
        texts[k] = " ".join(own[: 150 if k % 2 else 149])
    texts |= {k: " ".join(rng.choice(words, 30)) for k in range(150, 1000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    assert sum(got[k] != 0 for k in range(150)) <= 2  # a pair at 0.81 meets in no band once in 280 times
    assert all(got[k] == k for k in range(150, 1000))


def test_frequent_shingles_are_exact(spark):
    texts = {k: "all of these five words open " + f"{k} {k + 1} {k + 2} {k + 3} {k + 4}" for k in range(200)}
    known = minhash.weights(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5))
    assert len(known.hashes) == 2 and np.allclose(known.idf, 1)


def test_rare_shingles_have_full_inverse_document_frequency(spark):
    """Every document frequency counts, however small; of a group of copies one text is counted."""
    rng = np.random.default_rng(21)
    texts = {k: " ".join(map(str, rng.integers(0, 10**6, 60))) for k in range(100)}
    lines = {n: " ".join(f"line{n}word{k}" for k in range(5)) for n in (1, 2, 5, 20)}
    for n, line in lines.items():
        for k in range(n):
            texts[k] += " | " + line
    texts |= {100 + k: texts[90] + f" copy{k}" for k in range(40)}
    known = minhash.weights(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4))
    for n, line in lines.items():
        assert known.of(minhash.Shingler()([line])[0]) == pytest.approx([1 + np.log(100 / n)])
    assert known.of(minhash.Shingler()([texts[90]])[0]) == pytest.approx(1 + np.log(100))


def test_sketches_agree_as_texts_do():
    rng = np.random.default_rng(8)
    same = []
    for _ in range(50):
        pool = rng.integers(1, 2**63, 250).astype(np.uint64)
        both = [np.sort(rng.permutation(pool)[:200]) for _ in range(2)]
        one, two = minhash.sketches(np.concatenate(both), np.array([200, 200]))
        same.append(((one == two).mean(), len(np.intersect1d(*both)) / len(np.union1d(*both))))
    agree, similar = np.array(same).mean(axis=0)
    assert agree == pytest.approx(similar, abs=0.05)


def test_weights_of_signatures():
    """Samples agree as often as the weighted Jaccard similarity says."""
    rng = np.random.default_rng(4)
    shingles = np.sort(rng.integers(1, 2**62, 400).astype(np.uint64))
    same = []
    for _ in range(60):
        a, b = rng.permutation(400)[:300], rng.permutation(400)[:300]
        a, b = np.sort(a), np.sort(b)
        both = np.concatenate([shingles[a], shingles[b]]) ^ np.uint64(rng.integers(1, 2**40))
        bands = minhash.signatures(both, np.zeros(600), np.array([0, 300]))
        same.append(((bands[:, 0] == bands[:, 1]).mean(), len(np.intersect1d(a, b)) / len(np.union1d(a, b))))
    agree, similar = np.array(same).mean(axis=0)
    assert agree == pytest.approx(similar**minhash.ROWS, abs=0.08)


# ---------------------------------------------------------------- pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="x"><header>Site</header><nav><ul><li>a</li></ul></nav>
<!-- <p>no</p> --><div class='ad top'>Buy</div><article><header><h1>Title &amp; more</h1></header><p>One <b>two<br>three</b><p>Four&nbsp;five &lt;x&gt;<div class="share-buttons">Share</div><script>var a="</p>";</script>
<table><tr><td>a</td><td>b</td></tr></table></article><aside>Side</aside><div id="comments"><p>First!</p></div><form><p>Mail</p></form><footer>F</footer></body></html>"""


def test_page_text(spark):
    assert pages.main_text(PAGE, frozenset()) == "Title & more\n\nOne two three\n\nFour five <x>\n\na b"
    rows = spark.createDataFrame([(1, "http://h/1", PAGE), (2, None, None), (3, "x", ""), (4, "http://h/2", "plain < text"), (1, "http://h/1", PAGE)], "page_id bigint, url string, html string")
    got = [(r.page_id, r.text) for r in pages.extract(rows).orderBy("page_id").collect()]
    assert [t for _, t in got][2:] == ["", "", "plain < text"] and got[0] == got[1]
    assert pages.extract(rows.where("false")).count() == 0


def test_page_text_of_open_heads_and_names_in_articles():
    assert pages.main_text("<html><head><title>T</title><meta charset=utf-8><style>p{}</style><body><p>All of it", frozenset()) == "All of it"
    assert pages.main_text("<head><link rel=x><title>T</title><p>No body tag", frozenset()) == "No body tag"
    kept = "<h2 id='related-work'>A</h2><h2 id='search-results'>B</h2><p class='alert'>C</p><section id='comments-on-the-text'><p>D</p></section>"
    gone = "<div class='share-buttons'>x</div><div class='ad'>x</div><div id='comments'>x</div><div class='ad-slot-3'>x</div><div role='navigation'>x</div>"
    for tag in ("article", "main"):
        assert pages.main_text(f"<body><{tag}>{kept}{gone}</{tag}>", frozenset()) == "A\n\nB\n\nC\n\nD"
    assert pages.main_text("<body><div class='x'><h2 id='related-work'>A</h2></div><div class='related'>x</div>", frozenset()) == "A"


def test_names_count_as_a_whole():
    for page, want in {
        "<p class='related-work'>A</p><div class='share-price'>B</div>": "A\n\nB", "<div class='post'><header><h1>T</h1></header><p>x</p></div>": "T\n\nx",
        "<main><header class='site-header'>S</header><p>x</p></main>": "x", "<svg><svg></svg>no</svg><p>y</p>": "y", "<div class='main-nav'>n</div><header>H</header>z": "z",
    }.items():
        assert pages.main_text(page, frozenset()) == want


def test_tags_that_never_end_take_no_time():
    import time

    for text in ("<a" * 500_000, "<" + "a" * 1_000_000, "<a \"" * 250_000, "<a '\"" * 200_000, "<!" * 500_000, "</a x='" * 150_000, "<a b=" * 200_000, "<a\"" * 300_000):
        start = time.process_time()
        pages.parse(text)
        assert time.process_time() - start < 5


def test_odd_tags():
    assert pages.main_text("<body><p>a <b x=\"1>2\">b</b> c<!x y> d<?z> <e</p><p>f <i", frozenset()) == "a b c d <e\n\nf <i"


def test_pages_parse_in_linear_time():
    import time

    for form in (lambda n: "<div>x" * n, lambda n: "<div>" * n + "</section>" * n, lambda n: "<b>" * n + "<div>" + "<i>" * n + "</b>" * n, lambda n: "<p>" + "<span>" * n + "<h1>x" * n):
        start = time.process_time()
        pages.parse(form(20_000))
        assert time.process_time() - start < 20


def test_style_tree_finds_unmarked_menus(spark):
    page = "<body><div class='m'><p>Home</p><p>About</p></div><div class='c'><p>text {0} of its own {0}</p></div></body>"
    rows = spark.createDataFrame([(k, "http://one.example/x", page.format(k)) for k in range(30)], "page_id bigint, url string, html string")
    assert {r.text for r in pages.extract(rows).collect()} == {f"text {k} of its own {k}" for k in range(30)}


def test_style_tree_reaches_all_depths_and_articles(spark):
    page = "<div id='page'><div class='wrap'><div class='row'><div class='col'><div class='m'>Home About</div><div class='c'>own {0}</div></div></div></div></div><main><ul><li>Up Down</li></ul><h2>Notes</h2><p>text {0}</p></main>"
    rows = spark.createDataFrame([(k, "http://one.example/x", page.format(f"{k} {k}")) for k in range(30)], "page_id bigint, url string, html string")
    assert {r.text for r in pages.extract(rows).collect()} == {f"own {k} {k}\n\nNotes\n\ntext {k} {k}" for k in range(30)}


def test_hosts_with_pages_of_their_own_borrow_nothing(spark):
    rows = [(1000 * h + k, f"http://h{h}.example/{k}", f"<div>menu of {h}</div><p>page {h} {k}</p>") for h in range(20) for k in range(40)]
    rows += [(k - 100, "http://own.example/", f"<div>article {k}</div>") for k in range(20)]
    found = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [found[k - 100] for k in range(20)] == [f"article {k}" for k in range(20)] and found[3007] == "page 3 7"


def plain_tree(rows):
    """(host, branch): importance, and what each distinct page has low, worked out page by page."""
    import math

    seen = {}
    for url, html in rows:
        host = (re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", url or "") or ["", ""])[1].lower()
        seen[host, html or ""] = {b: (f.content.intdigest(), f.below.intdigest()) for b, f in pages.parse(html)[1].items()}
    nodes = [(host, html, b, *v) for (host, html), found in seen.items() for b, v in found.items()]
    n, hosts, total = Counter((h, b, c) for h, _, b, c, _ in nodes), {}, Counter((h, b) for h, _, b, _, _ in nodes)
    for h, _, b, c, _ in nodes:
        hosts.setdefault((b, c), set()).add(h)
    again = {k: n[k] > 1 or len(hosts[k[1:]]) > 1 for k in n}
    share = {k: sum(n[x] for x in n if x[:2] == k and again[x]) / total[k] for k in total}
    entropy = lambda counts, m: 1.0 if m == 1 else -sum(k / m * math.log(k / m) for k in counts) / math.log(m)
    importance = {}
    for h, b in total:
        over = [share[k] for k in share if k[1] == b]
        m = total[h, b]
        unlike = 1 - (share[h, b] * m + pages.LEAN * sum(over) / len(over)) / (m + pages.LEAN)
        both = max(entropy([k for x, k in n.items() if x[:2] == (h, b)], m), entropy(Counter(s for a, _, x, _, s in nodes if (a, x) == (h, b)).values(), m))
        importance[h, b] = min(unlike, both)
    low = {}
    for h, html, b, c, _ in nodes:
        limit = min(pages.LIMIT, (1 + min(v for k, v in importance.items() if k[0] == h)) / 2)
        if again[h, b, c] and importance[h, b] < limit:
            low.setdefault((h, html), {})[b] = n[h, b, c] > 1 and n[h, b, c] >= pages.COMMON * total[h, b]
    return importance, low


def test_tree_equals_plain_tree(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet").select("url", "html")
    rng = np.random.default_rng(1)
    made = [(f"http://h{int(rng.integers(0, 4))}.example/{k}", f"<div class='m{k % 3}'>menu {int(rng.integers(0, 3))}</div><div><p>text {k}</p><p>{'same' if k % 2 else k}</p></div>") for k in range(40)]
    rows = [tuple(r) for r in table.collect()] + made + made[:3] + [(None, None), (None, "<p>x</p>")]
    df = spark.createDataFrame(rows, "url string, html string")
    importance, low = plain_tree(rows)
    nodes = pages.page_nodes(df)
    got = {(r.host, r.branch): r.importance for r in pages.style_tree(nodes)[1].collect()}
    assert set(got) == set(importance) and max(abs(got[k] - importance[k]) for k in got) < 1e-9
    numbers = {r._number: (r._host, r._page) for r in pages._numbered(df, "url", "html").collect()}
    found = {numbers[r.page]: {b: b in r.common for b in r.low} for r in pages.low_nodes(nodes).collect()}
    assert found == low and low


def test_tree_alone_removes_what_comes_again(spark):
    """With tags and names switched off: every menu and advert whose content recurs goes, and no block of an article."""
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in table.collect()}
    alone = {r.page_id: r.text.split("\n\n") for r in pages.extract(table, marks=False).collect()}
    whole = {k: pages.main_text(r.html, frozenset()).split("\n\n") for k, r in rows.items()}
    part = lambda html, tag: re.findall(rf"<{tag}[ >].*?</{tag.split()[0]}>", html, re.DOTALL)
    noise = {k: [pages.main_text(x, frozenset(), marks=False) for x in (*part(r.html, "nav"), *part(r.html, 'div class="ad"'))] for k, r in rows.items()}
    count = Counter(x for found in noise.values() for x in set(found))
    recurring = [(k, x) for k, found in noise.items() for x in found if x and count[x] > 1]
    assert len(recurring) > 100
    left = [(k, x) for k, x in recurring if all(block in alone[k] for block in x.split("\n\n")) and not all(block in whole[k] for block in x.split("\n\n"))]
    assert not left
    assert not [k for k in rows if Counter(whole[k]) - Counter(alone[k])]


def test_few_pages_need_no_switch(spark):
    """A menu that one-page hosts share goes; what but one host says stays."""
    rows = [(k, f"http://h{k}.example/", f"<div>Home About Contact</div><div class='t'>text {k}</div><div class='own'>of host {k}</div>") for k in range(5)]
    found = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {k: f"text {k}\n\nof host {k}" for k in range(5)}


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark):
    import corpus_pipeline

    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs, known = documents(spark), None
    model = queries.toxicity_model(spark, SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        assert docs.columns == documents(spark).columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            scores = toxicity.Scorer(model).scores([r.text or "" for r in before.values()])
            assert set(after) == {k for k, s in zip(before, scores) if s < toxicity.THRESHOLD}
        elif name == "language":
            assert set(after) == {k for k, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif name == "near copies":
            known = plain_classes({k: r.text for k, r in before.items()}, minhash.weights(spark.createDataFrame(list(before.values()), docs.schema)))
            assert set(after) == {k for k, c in known.items() if k == c}
        else:
            assert {k: r.text for k, r in after.items()} == {k: pii.redacted(r.text, pii.spans_of(r.text)) for k, r in before.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_near_copies_keep_other_texts_of_an_id(spark):
    import corpus_pipeline

    rng = np.random.default_rng(13)
    one, two, three, four = (" ".join(map(str, rng.integers(0, 10**6, 60))) for _ in range(4))
    rows = [(1, one), (2, one + " more"), (2, two), (3, three), (3, three), (3, four), (4, four), (5, None), (5, None), (None, two)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    want = [(1, one), (2, two), (3, three), (3, four), (5, None), (None, two)]
    assert got.columns == docs.columns and Counter(map(tuple, got.collect())) == Counter(want)


CONTRACTS = {
    "op1_embedding_dedup": "vec_id bigint n_links bigint component_id bigint kept boolean", "op2_pii": "doc_id bigint n_email bigint n_ip bigint n_card bigint n_phone bigint base_sha256 string spans string",
    "op3_neighbours": "query_id bigint rank int vec_id bigint score double", "op4_toxicity": "doc_id bigint held_out boolean score double predicted int", "op5_language": "doc_id bigint held_out boolean lang_pred string score double",
    "op7_packing": "doc_id bigint start bigint length bigint ids_crc32 bigint doc_tokens bigint sequence_id bigint offset bigint", "op8_quality": "doc_id bigint held_out boolean score double predicted int",
    "op9_byte_bpe": "doc_id bigint n_tokens bigint ids_sha256 string decoded_sha256 string", "op10_html": "page_id bigint url string text string n_chars bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract_columns(spark, name):
    fields = CONTRACTS[name].split()
    got = queries.QUERIES[name](spark, SF)
    assert got.dtypes[: len(fields) // 2] == list(zip(fields[::2], fields[1::2], strict=True))
    table = {"op1_embedding_dedup": "embeddings", "op3_neighbours": "embeddings", "op10_html": "pages"}.get(name, "documents")
    if name not in ("op3_neighbours", "op7_packing"):
        assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline_takes_clashing_names(spark):
    import corpus_pipeline

    rows = [(1, "some plain text of words", 3, "x", 1), (2, None, 4, "y", 2), (3, "", 5, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxicity_score int, language string, class int")
    kept = corpus_pipeline.keep_languages(spark, corpus_pipeline.drop_toxic(spark, docs, SF), SF)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
    assert corpus_pipeline.drop_near_copies(spark, docs, SF).columns == docs.columns


def test_hash_of_packed_words():
    data = np.array([1, 70000, 2**31], np.uint32)
    assert bpe.unpack_ints(bpe.pack_ints(data)).tolist() == data.tolist() and bpe.unpack_ints(bpe.pack_ints(data[:0])).tolist() == []
    assert bpe.unpack_all(bpe.pack_all(b"a", b"", b"bc")) == [b"a", b"", b"bc"]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
