"""Tokenizer alignment against whole-text encodings and all overlapping pairs."""

from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from offerloom.llm import alignment

SCHEMA = "doc_id long, text string, row string, key string, n string, slot string"
TEXTS = [None, "", " ", "a", " a", "a ", "a  b", "a   b c", "Hello, world! It's 10 o'clock.", "été où ça été", "x▁y z", "x▁ y", "▁", "a ▁ b",
         "<|endoftext|> and <s> </s> <unk> <0x41>", "a<|endoftext|>b", "tab\tnew\nline\r\n  indented", "\n\n\n a \x00 b", " a  b 　c",
         "emoji 😀😀 👩‍👩‍👧 flags 🇫🇷", "日本語のテキスト です", "é combining", "\x1c a \x1d b\x85 c", "longword" * 700, "the cat and the dog " * 300,
         "don't we'll 'tis l'offre", "1234567890 12 3.14", "﻿bom zero​width"]


def brute(rows):
    a = Tokenizer.from_file(alignment.A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.B_FILE)
    letters = alignment._byte_of_letter()
    parts, pairs = [], Counter()
    for _, text in rows:
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in b_ids for p in [b.id_to_piece(i)]]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            a_ids, b_ids, a_bytes, b_bytes = [], [], [], []
        a_end, b_end = np.cumsum([len(x) for x in a_bytes], dtype=int), np.cumsum([len(x) for x in b_bytes], dtype=int)
        links = [(x, y) for i, x in enumerate(a_ids) for j, y in enumerate(b_ids)
                 if max(a_end[i] - len(a_bytes[i]), b_end[j] - len(b_bytes[j])) < min(a_end[i], b_end[j])]
        cuts, groups, at = sorted({*a_end.tolist()} & {*b_end.tolist()}), [], 0
        for c in cuts:
            groups.append(",".join(str(x) for x, e in zip(a_ids, a_end) if at < e <= c) + "|" + ",".join(str(x) for x, e in zip(b_ids, b_end) if at < e <= c))
            at = c
        parts.append((a_ids, b_ids, groups, links))
        pairs.update(links)
    best = Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    return Counter((d, len(a_ids), len(b_ids), len(groups), len(links), sum(pairs[p] == best[p[1]] for p in links), sum(pairs[p] for p in links),
                    sha256(";".join(groups).encode()).hexdigest() if a_ids else "")
                   for (d, _), (a_ids, b_ids, groups, links) in zip(rows, parts))


ROWS = [(i, t) for i, t in enumerate(TEXTS) if t is None or len(t) < 3000] + [(3, "a"), (None, "no id"), (3, "the other")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["clash"] * 4) for r in ROWS], SCHEMA).repartition(4)


@pytest.mark.parametrize("table_pairs, shard_keys", [(alignment.TABLE_PAIRS, alignment.SHARD_KEYS), (alignment.TABLE_PAIRS, 20), (64, 32)])
def test_digest_is_brute_force(docs, table_pairs, shard_keys):
    out = alignment.alignment_digest(docs, table_pairs=table_pairs, shard_keys=shard_keys)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in out.collect()) == brute(ROWS)


def test_empty(docs):
    assert alignment.alignment_digest(docs.limit(0)).count() == 0
    rows = alignment.alignment_digest(docs.where("text is null or text = ''")).collect()
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "")}


@pytest.fixture(scope="module")
def aligner():
    with open(alignment.A_FILE, "rb") as a, open(alignment.B_FILE, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(alignment.A_FILE)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_every_character_is_cut_as_the_file_says(aligner, whole):
    """The encoder by ranks and that of the file agree on every character of the basic plane and the next."""
    texts = [f" a{c}b{c}{c} {c}1{c}.{c}  {c}" for c in map(chr, range(0x20000)) if not 0xD800 <= ord(c) < 0xE000]
    for i in range(0, len(texts), 8192):
        part = texts[i:i + 8192]
        assert aligner.encode_a(part) == [e.ids for e in whole.encode_batch(part, add_special_tokens=False)]
    with open(alignment.A_FILE, "rb") as f:
        assert alignment._whole(f.read())(texts[:99]) == aligner.encode_a(texts[:99])


@pytest.mark.parametrize("run", [" ", "\n", "\u3000", "a", "^"])
@pytest.mark.parametrize("length", [alignment.LONG_RUN - 2, alignment.LONG_RUN + 2, 1_500_000])
def test_very_long_runs_encode_as_the_file_says(aligner, whole, run, length):
    texts = [" " + run * length, " x" + run * length + "y z"]
    assert aligner.encode_a(texts) == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_no_token_crosses_a_cut(aligner):
    """The stretches of a text may be encoded alone only if no token joins the end of one and the begin of the next."""
    for tokens in (aligner.a_bytes, aligner.b_bytes):
        for t in tokens:
            assert not alignment.CUT.search(t.decode(errors="replace")), t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "  ", "é", "▁", "\n", "\t", "'s", "12", "<s>", "😀", " ", "\x1c", "Ab", ".", "日本", "é", "\x00"]), max_size=25))
def test_stretches_encode_like_the_whole(aligner, whole, parts):
    text = "".join(parts)
    pieces = alignment.CUT.split(text)
    a = [i for s in pieces for i in aligner.encode_a([" " + s])[0]]
    b = [i for s in pieces for i in aligner.b.encode(s)]
    if text:
        assert a == whole.encode(" " + text, add_special_tokens=False).ids
        assert b == aligner.b.encode(text)


@pytest.mark.parametrize("size", [0, 1, 2, 63, 5000])
def test_hash_is_minimal_and_perfect(size):
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, size))
    shards = 3
    shard = alignment._shard_of(keys, shards)
    built = [alignment.hash_levels(keys[shard == s]) for s in range(shards)]
    perfect = alignment.PerfectHash.of(0, shards, [b[0] for b in built], [b[1] for b in built])
    assert sorted(perfect.slots(keys).tolist()) == list(range(len(keys)))
    part = alignment.PerfectHash.of(1, shards, [b[0] for b in built[1:]], [b[1] for b in built[1:]])
    slots = part.slots(keys)
    assert (slots[shard == 0] == -1).all() and sorted(slots[shard > 0].tolist()) == list(range(int((shard > 0).sum())))


def test_unknown_pairs_are_refused():
    keys = np.arange(1000, dtype=np.int64)
    sizes, words = alignment.hash_levels(keys)
    perfect = alignment.PerfectHash.of(0, 1, [sizes], [words])
    held = np.zeros(1000, np.int64)
    held[perfect.slots(keys)] = keys
    table = alignment.Table(perfect, held, held * 2)
    assert (table.look_up(keys[::7]) == keys[::7] * 2).all()
    with pytest.raises(KeyError):
        table.look_up(np.arange(10_000, 20_000))
