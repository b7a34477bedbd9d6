"""Encoding, token files and packing."""

import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_tables import awkward, documents, empty  # noqa: F401
from presslens.llm import packing, token_files
from presslens.llm.tokens import COMMON, Encoder, vocabulary

PATH = vocabulary("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
WORDWISE = Encoder(PATH, limit=50)


def ids(text, end):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, end]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aAbB 'sStTrRvVeEmMlLdD9<|>.\n\t\x0b\x1c\x85é́Σ", max_size=40)))
def test_encoder_agrees_with_the_library(text):
    assert np.frombuffer(WORDWISE.encode(text), WORDWISE.dtype).tolist() == ids(text, 0)[:-1]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "I'll don't 'S x'sy", " a　b", "Ａ ﬁ İ ẞ ǅ"])
def test_encoder_on_special_texts(text):
    assert np.frombuffer(WORDWISE.encode(text), WORDWISE.dtype).tolist() == ids(text, 0)[:-1]


def test_encoder_on_every_common_letter():
    letters = [chr(c) for c in range(0x21, 0x180) if COMMON.fullmatch(chr(c))]
    assert len(letters) == 94 + 186  # printable ASCII, Latin letters
    for x in letters:
        text = f"{x} {x}{x}a a{x}' {x}'s 1{x}\t({x})e"
        assert np.frombuffer(WORDWISE.encode(text), WORDWISE.dtype).tolist() == ids(text, 0)[:-1], x


def test_spellings_of_a_word_are_encoded_once():
    enc, asked = Encoder(PATH), []
    enc.model = SimpleNamespace(tokenize=lambda x: asked.append(x) or PLAIN.model.tokenize(x))
    text = 'Élan élan, (ÉLAN) "élan"\nélan,'
    assert np.frombuffer(enc.encode(text) + enc.encode(text + " 文 élan."), enc.dtype).tolist() == ids(text, 0)[:-1] + ids(text + " 文 élan.", 0)[:-1]
    assert sorted(asked) == sorted({"Ã©lan", ",", "(", ")", '"', "."})


def test_other_vocabularies_encode_whole_texts():
    path = vocabulary("byte_bpe_50k.json")
    enc = Encoder(path)
    text = "Two  spaces and\na line's end "
    assert not enc.wordwise
    assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_token_file_round_trip(tmp_dir):
    rng = np.random.default_rng(1)
    uri, dtype = f"file://{tmp_dir}/x/t.arrow", np.dtype("<u2")
    out = token_files.TokenFileWriter(uri, dtype, sequence=8, batch=3)
    docs = [rng.integers(0, 49_000, n).astype(dtype) for n in (1, 0, 23, 24, 25, 100, 7, 48)]
    for d in docs:
        out.add(d)
    out.close()
    file, flat = token_files.TokenFile(uri), np.concatenate(docs)
    assert out.written == len(flat) and len(file) == -(-len(flat) // 8)
    for i in range(len(file)):
        row, mask = file.row(i)
        part = flat[8 * i : 8 * i + 8]
        assert row[mask].tolist() == part.tolist() and mask.sum() == len(part)
        assert not row.flags.owndata  # a view of the mapped file
    at = 0
    for d in docs:
        assert file.span(at, len(d)).tolist() == d.tolist() if len(d) else True
        at += len(d)


def test_files_hold_documents_in_order(documents, empty):
    texts = [(i, f"word{i} " * (i % 7)) for i in range(60)] + [(None, "x"), (12, "again"), (3, None)]
    got = token_files.read(token_files.write(documents(texts), PATH, 2, sequence=16, batch=2)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(ids(t, 2)), crc(ids(t, 2))) for d, t in texts)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert token_files.read(token_files.write(empty, PATH, 2)).count() == 0


def check_plan(counts):
    capacity = len(counts) - 1
    plan, placed = packing.plan(counts), {}
    for length, first, times, sequence, offset in zip(*plan.values()):
        placed.setdefault(int(length), []).append((int(first), int(times), int(sequence), int(offset)))
    sequences = {}
    for length, runs in placed.items():
        runs.sort()
        runs.append((int(counts[length]), 0, 0, 0))
        assert runs[0][0] == 0
        for (first, times, sequence, offset), after in zip(runs, runs[1:]):
            for k in range(after[0] - first):
                sequences.setdefault(sequence + k // times, []).append((offset + k % times * length, length))
    assert sum(map(len, sequences.values())) == counts.sum()
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("seed", range(25))
def test_plans_are_gapless_and_tight(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 60))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for x in rng.integers(1, capacity + 1, int(rng.integers(0, 80))):
        counts[x] += int(rng.integers(1, 5))
    used = check_plan(counts)
    bound = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    assert bound <= used <= max(bound * 11 // 9 + 1, bound)


def fewest(items, capacity):
    """Exact bin packing by search."""
    best, items = [len(items)], sorted(items, reverse=True)

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= items[i]}:
            at = rooms.index(r)
            go(i + 1, [*rooms[:at], r - items[i], *rooms[at + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(30))
def test_reduction_never_costs_a_sequence(seed):
    rng = random.Random(seed)
    capacity = 20
    items = [rng.randint(1, capacity) for _ in range(9)]
    counts = np.bincount(items, minlength=capacity + 1).astype(np.int64)
    left = counts.copy()
    fixed = sum(n for n, _ in packing.dominance(left))
    rest = [x for x in range(capacity + 1) for _ in range(left[x])]
    assert fixed + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)


def test_packing_of_documents(awkward, empty):
    got = packing.pack(awkward, PATH, 1, capacity=64, with_ids=True).collect()
    assert Counter((r.doc_id, r.piece) for r in got if r.doc_id == 3) == {(3, 0): 2}
    whole = sorted((r.start, r.ids) for r in got if r.doc_id == 5)
    assert np.frombuffer(b"".join(x for _, x in whole), "<u4").tolist() == ids("w " * 30_000, 1)
    filled = {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(r.ids) and 4 * r.length == len(r.ids)
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == np.r_[0, np.cumsum([n for _, n in parts])[:-1]].tolist() and sum(n for _, n in parts) <= 64
    assert packing.pack(empty, PATH).count() == 0


def test_sequences_put_together(documents):
    packed = packing.pack(documents([(i, "a b c d " * i) for i in range(6)]), PATH, capacity=16, with_ids=True)
    lengths = {r.sequence_id: r.n for r in packed.groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()}
    for r in packing.sequences(packed).collect():
        assert len(r.ids) == 4 * lengths[r.sequence_id]
