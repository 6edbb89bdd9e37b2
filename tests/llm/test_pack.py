import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recado.llm import pack, tokens

SCHEMA = "doc_id long, text string, length string, piece string, offset int"


def ids_of(text):
    import public_tokenizers as files
    from tokenizers import Tokenizer

    ids_of.t = getattr(ids_of, "t", None) or Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    return ids_of.t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=st.sampled_from(list("ab éß’'s 12²ªº\n\t\r\x0b\xa0\x85ɏ-|<|endoftext|>")), max_size=60))
def test_both_encoders_agree(text):
    assert pack.encoder(pack.VOCABULARY).ids(text) == ids_of(text)


def test_whole_plain_repertoire():
    rng = random.Random(4)
    plain = [chr(c) for c in range(0x2050) if not tokens.PLAIN.search(chr(c))]
    for _ in range(300):
        text = "".join(rng.choices(plain, k=80))
        assert pack.encoder(pack.VOCABULARY).ids(text) == ids_of(text)
    assert pack.encoder(pack.VOCABULARY).ids("a <|endoftext|> b") == ids_of("a <|endoftext|> b")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60), max_size=12))
def test_plan_packs_every_piece_once(histogram):
    groups = pack.plan(histogram, 32)
    used = Counter()
    for group, count in groups:
        assert sum(a * b for a, b in group) <= 32 and count > 0
        for length, times in group:
            used[length] += times * count
    assert used == Counter(histogram)
    total = sum(a * b for a, b in histogram.items())
    assert sum(c for _, c in groups) <= max(total * 3 // 2 // 32 + 1, sum(n for a, n in histogram.items() if a > 16) + total // 32 + 1)


def test_patterns_beat_or_meet_best_fit_on_a_broad_histogram():
    rng = random.Random(9)
    histogram = Counter(min(2047, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(20_000))
    total = sum(a * b for a, b in histogram.items())
    assert sum(c for _, c in pack.plan(dict(histogram))) <= -(-total // 2048) * 1.005


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    words = "the a token Wort mot été x1 ### !! ñ 漢字 🙂".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 400))), "x", "y", 1) for i in range(150)]
    rows += [(900, "same text", "x", "y", 1)] * 40 + [(901, None, "x", "y", 1), (902, "", "x", "y", 1), (None, "no id", "x", "y", 1)]
    rows += [(903, "word " * 30_000, "x", "y", 1), (904, "a" * 5000, "x", "y", 1), (905, " " * 9000, "x", "y", 1), (906, "tok " * 2047, "x", "y", 1)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_pieces_and_places(docs):
    rows, table = docs
    got = pack.packed(table).collect()
    assert pack.packed(table).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    want = Counter()
    for i, text, *_ in rows:
        ids = [*ids_of(text), 0]
        first = (len(ids) - 1) % 2048 + 1
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 2048)], [*range(first, len(ids) + 1, 2048)], strict=True)):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= -(-sum(r.length for r in got) // 2048) + 2


def test_sequences_hold_the_ids(docs):
    rows, table = docs
    packed = pack.packed(table.where("doc_id < 40"), with_ids=True)
    ids = Counter(i for r in pack.sequences(packed).collect() for i in r.ids)
    assert ids == Counter(i for d, text, *_ in rows if d is not None and d < 40 for i in [*ids_of(text), 0])


def test_empty(spark):
    assert pack.packed(spark.createDataFrame([], SCHEMA)).collect() == []


def test_common_lengths_are_ranked_in_shares(docs, monkeypatch):
    monkeypatch.setattr(pack, "SHARE_ROWS", 3)
    test_pieces_and_places(docs)
