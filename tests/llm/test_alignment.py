"""Alignment of tokenizers against dictionaries of all links."""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import cache

import data
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hazardlake.llm import alignment, queries

MODELS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@cache
def libraries():
    a = Tokenizer.from_file(MODELS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODELS[1])


@cache
def letters():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def tokens(text):
    """``[(id, bytes)]`` of both sides, empty if one of them loses bytes."""
    if not text:
        return [], []
    a, b = libraries()
    left = [(i, bytes(letters()[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in side) != whole for side in (left, right)):
        return [], []
    return left, right


def plain(texts):
    """What the operator should return for each text, by all pairs of ends."""
    rows, links = [], []
    for text in texts:
        left, right = tokens(text)
        ends = [dict(zip(np.cumsum([len(x) for _, x in side]).tolist(), range(len(side)), strict=True)) for side in (left, right)]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for e in both:
            x, y = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(str(t) for t, _ in left[i:x]) + "|" + ",".join(str(t) for t, _ in right[j:y]))
            i, j = x, y
        links.append([(left[ends[0][e]][0], right[ends[1][e]][0]) for e in both])
        written = ";".join(groups)
        rows.append([len(left), len(right), len(groups), len(both), hashlib.sha256(written.encode()).hexdigest() if written else "", written])
    counts = Counter(pair for found in links for pair in found)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for row, found in zip(rows, links, strict=True):
        best = sum(counts[p] == most[p[1]] for p in found)
        out.append((*row[:4], best, sum(counts[p] for p in found), *row[4:]))
    return out, counts


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_op11_equals_dictionaries(spark, texts):
    want, _ = plain([t for _, t in texts])
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_alignment"](spark, data.SF).collect()}
    assert got == {i: row[:7] for (i, _), row in zip(texts, want, strict=True)}


def test_small_slices_and_groups_change_nothing(spark, docs, texts):
    want, counts = plain([t for _, t in texts])
    found = alignment.align(docs, *MODELS, groups=True, radixes=3, slice_bytes=20_000, group_bytes=5_000)
    got = {r.doc_id: tuple(r[c] for c in [*COLUMNS, "groups"]) for r in found.select("row.*", *COLUMNS, "groups").collect()}
    assert got == {i: row for (i, _), row in zip(texts, want, strict=True)}
    pairs = {(r.a, r.b): r.n for r in alignment.pair_counts(docs, *MODELS, group_bytes=5_000).collect()}
    assert pairs == counts


def test_alignment_of_odd_rows(spark, hostile, nothing):
    rows = alignment.align(hostile, *MODELS, groups=True).collect()
    want = Counter(map(repr, zip([t for _, t, _ in data.ROWS], plain([t for _, t, _ in data.ROWS])[0], strict=True)))
    assert Counter(repr((r.row.text, tuple(r[c] for c in [*COLUMNS, "groups"]))) for r in rows) == want
    assert rows[0].row.asDict().keys() == set(hostile.columns)
    assert alignment.align(nothing, *MODELS).count() == alignment.pair_counts(nothing, *MODELS).count() == 0


def test_special_strings_marks_and_bad_bytes(spark):
    rows = [(1, "<|endoftext|> and <s> stay text</s>"), (2, "a ▁ mark"), (3, "tabs\tand  two blanks \n"), (4, "Ᲊ new, \u0085 odd \x1c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bad = spark.sql("SELECT 5L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    got = {r.row.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs.unionByName(bad), *MODELS).collect()}
    want, _ = plain([t for _, t in rows])
    assert {i: got[i] for i, _ in rows} == {i: w[:7] for (i, _), w in zip(rows, want, strict=True)}
    assert got[1][0] > 8 and got[2][0] == 0 and got[5] == (0, 0, 0, 0, 0, 0, "")


def test_ranks_equal_the_library():
    model = alignment.ByteLevel(open(MODELS[0], "rb").read())
    rng = np.random.default_rng(6)
    settled = np.flatnonzero(model.settled)
    pool = np.concatenate((settled[settled < 0x500], settled[settled < 0x80].repeat(20), rng.choice(settled, 20_000)))
    texts = [" " + "".join(map(chr, rng.choice(pool, rng.integers(1, 200)))) for _ in range(400)]
    library = [e.ids for e in model.library.encode_batch(texts, add_special_tokens=False)]
    assert model.encode(texts) == library
    assert [model.ranks.encode_ordinary(t) for t in texts] == library


@pytest.mark.parametrize("columns", [[[]], [[0, 5, 2**40], [7]], [[-3], [], [1, 2]]])
def test_packed_columns_return(columns):
    columns = [np.array(c, np.int64) for c in columns]
    assert [c.tolist() for c in alignment._unpack(alignment._pack(*columns))] == [c.tolist() for c in columns]
