"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A document is cut into phrases, each the
longest match with that language's text; the language that needs the fewest phrases, normalised by the size
of its text, wins. All letters of all languages have codes of their own. The automata's transitions are stored
in one hash table by state and letter, and many stretches of text step through all languages together.

A long text is parsed in stretches of STRETCH characters, all of them; a cut costs each language one phrase.

Defined results: a null, empty or letterless text is ``und`` with score 0; without any labelled text every
document is; ties go to the language that sorts first; repeated rows come back as often; an empty table
gives an empty table. Only key, text and, for learning, the language column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm.common import slices, text_rows

#: The bounded labelled sample: so many documents of each language at most, and no more once they have so many characters.
SAMPLE_DOCS, SAMPLE_CHARS = 64, 40_000
STRETCH = 512
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # by code point: 0 no letter, 1 a letter unseen in learning, else its code
    slots: np.ndarray  # hash table of state * width + code, -1 where free; states of all languages
    to: np.ndarray  # the next state, by slot
    first: np.ndarray  # by language and code: where a new phrase leads; an unseen letter is a phrase of its own
    outside: int  # the state before a phrase: nothing leads on
    cost: np.ndarray  # bits that a phrase costs, by language
    width: int


def letters(text: str, codes: np.ndarray) -> np.ndarray:
    """Codes of the lower-cased text; each run of other characters is one 0."""
    got = codes[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    keep = got != 0
    keep[1:] |= got[:-1] != 0
    return got[keep]


def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - slots.bit_length())).astype(np.intp)


def hashed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their values in a table with linear probing, a quarter full at most."""
    n = 1 << max((4 * len(keys)).bit_length(), 4)
    slots, to = np.full(n, -1, np.int64), np.full(n, -1, np.int32)
    at, left = _slot(keys, n), np.arange(len(keys))
    while len(left):
        free = left[slots[at[left]] < 0]
        placed = free[np.unique(at[free], return_index=True)[1]]
        slots[at[placed]], to[at[placed]] = keys[placed], values[placed]
        left = np.setdiff1d(left, placed, assume_unique=True)
        at[left] = (at[left] + 1) & (n - 1)
    return slots, to


def follow(model: Model, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Next states, -1 where there is none."""
    keys = state.astype(np.int64) * model.width + code
    at = _slot(keys, len(model.slots))
    held = model.slots.take(at)
    out = np.where(held == keys, model.to.take(at), -1)
    others = np.flatnonzero((held != keys) & (held >= 0))
    keys, at = keys.reshape(-1)[others], at.reshape(-1)[others]
    while len(others):
        at = (at + 1) & (len(model.slots) - 1)
        held = model.slots.take(at)
        hit = held == keys
        out.reshape(-1)[others[hit]] = model.to.take(at[hit])
        on = ~hit & (held >= 0)
        others, keys, at = others[on], keys[on], at[on]
    return out


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """The transitions of the minimal automaton of all substrings, by state."""
    nexts: list[dict[int, int]] = [{}]
    links, sizes, last = [-1], [0], 0
    for c in text.tolist():
        new = len(nexts)
        nexts.append({})
        links.append(0)
        sizes.append(sizes[last] + 1)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = links[p]
        if p >= 0:
            q = nexts[p][c]
            if sizes[p] + 1 != sizes[q]:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                links.append(links[q])
                sizes.append(sizes[p] + 1)
                links[q] = copy
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = links[p]
                q = copy
            links[new] = q
        last = new
    return nexts


def learn(samples: dict[str, str]) -> Model:
    languages = sorted(samples)
    seen = sorted({c for t in samples.values() for c in t.lower() if c.isalpha()})
    codes = np.zeros(0x110000, np.uint16 if len(seen) < 65_000 else np.uint32)
    alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    codes[alpha] = 1
    for k, c in enumerate(seen):
        codes[ord(c)] = k + 2
    width, roots, sizes, at = len(seen) + 2, [], [], 0
    keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for language in languages:
        text = letters(samples[language], codes)
        own = suffix_automaton(text)
        n = sum(map(len, own))
        keys.append(np.fromiter(((at + state) * width + c for state, by_code in enumerate(own) for c in by_code), np.int64, n))
        values.append(np.fromiter((at + to for by_code in own for to in by_code.values()), np.int32, n))
        roots.append({c: at + to for c, to in own[0].items()})
        sizes.append(len(text))
        at += len(own)
    first = np.full((len(languages), width), at, np.int32)
    for k, by_code in enumerate(roots):
        for c, to in by_code.items():
            first[k, c] = to
    slots, to = hashed(np.concatenate(keys), np.concatenate(values))
    return Model(languages, codes, slots, to, first, at, np.log2(np.maximum(sizes, 2)), width)


def phrases(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """How many phrases each language needs for each text: a row for each text."""
    owner, start = [], []
    for k, t in enumerate(texts):
        cuts = range(0, len(t), STRETCH)
        owner += [k] * len(cuts)
        start += cuts
    counts = np.zeros((len(texts), len(model.languages)))
    if not owner:
        return counts
    owner_, start_ = np.array(owner), np.array(start)
    length = np.minimum(np.array([len(t) for t in texts])[owner_] - start_, STRETCH)
    order = np.argsort(-length, kind="stable")
    lanes = np.zeros((STRETCH, len(order)), np.int32)
    for lane, k in enumerate(order.tolist()):
        lanes[: length[k], lane] = texts[owner[k]][start[k] : start[k] + length[k]]
    active = np.searchsorted(-length[order], -np.arange(1, STRETCH + 1), side="right")
    n_lang = len(model.languages)
    state = np.full((n_lang, len(order)), model.outside, np.int32)
    begun = np.zeros((n_lang, len(order)), np.int32)
    rows = (np.arange(n_lang) * model.width)[:, None]
    flat_first = model.first.reshape(-1)
    for j in range(STRETCH):
        n = int(active[j])
        if not n:
            break
        c = lanes[j, :n]
        to = follow(model, state[:, :n], c)
        fail = to < 0
        begun[:, :n] += fail
        state[:, :n] = np.where(fail, flat_first.take(rows + c), to)
    np.add.at(counts, owner_[order], begun.T)
    return counts


def sample(df: DataFrame, lang: str = "lang", key: str = "doc_id", text: str = "text") -> dict[str, str]:
    """Text of each language: whole documents, SAMPLE_DOCS at most, until they have SAMPLE_CHARS characters.

    Ids are dealt to SAMPLE_DOCS buckets by hash, and each bucket gives one document: of those with at most
    SAMPLE_CHARS / 4 characters that with the least hash, or else the shortest.
    """
    rows = df.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("_lang"), F.col(text).alias("_text"), F.xxhash64(F.col(key), F.lit(7)).alias("_hash"))
    over = F.greatest(F.length("_text") - SAMPLE_CHARS // 4, F.lit(0))
    rows = rows.withColumns({"_bucket": F.pmod(F.col("_hash"), F.lit(SAMPLE_DOCS)), "_rank": F.struct(over.alias("over"), "_hash")}).drop("_hash")
    least = rows.groupBy("_lang", "_bucket").agg(F.min("_rank").alias("_rank"))
    picked = rows.join(F.broadcast(least), ["_lang", "_bucket", "_rank"]).select("_lang", "_rank", "_text")  # SAMPLE_DOCS rows a language
    out: dict[str, str] = {}
    for r in sorted(picked.collect()):
        if len(out.get(r["_lang"], "")) < SAMPLE_CHARS:
            out[r["_lang"]] = out.get(r["_lang"], "") + "\n" + r["_text"]
    return out


def predict(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """The language and score of each text; the score is the winner's share when shares fall with the fourth power of the rate."""
    coded = [letters(t, model.codes) for t in texts]
    found, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if model.languages and texts:
        rate = phrases(coded, model) * model.cost / np.maximum([len(c) for c in coded], 1)[:, None]
        weight = np.maximum(rate, 1e-9) ** -4
        best = rate.argmin(axis=1)
        for k, c in enumerate(coded):
            if c.any():
                found[k], scores[k] = model.languages[best[k]], weight[k, best[k]] / weight[k].sum()
    return found, scores


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, lang_pred, score."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_rows(batches, key, text, 1024):
            found, scores = predict(texts, shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found), pa.array(scores)], [key, "lang_pred", "score"])

    return df.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(scan, f"`{key}` bigint, lang_pred string, score double")


def add_language(df: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """``df`` with one more column, the language of ``text``; rows stay where they are. ``name`` must be new."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, 1024):
            found, _ = predict([t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*part.schema.names, name])

    return df.mapInArrow(scan, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))
