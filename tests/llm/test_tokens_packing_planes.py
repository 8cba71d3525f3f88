import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import table, words

from starfold.llm import packing, planes, tokens
from starfold.llm.queries import vocabulary


@pytest.fixture(scope="module")
def whole():
    """Ids of whole texts, encoded at once."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


TEXTS = [None, "", " ", "Plain text. It's WE'LL, (maybe)!", "a\u0301 B\u0301. é, Ünï", "ΣΑΣ ΟΔΟΣ.", "İstanbul İ,", "x<|endoftext|> y<|EndOfText|>, z",
         "a b c\x1cd\x85e\x0bf\x0cg\u2028h", "日本語 テスト。", "1234 5,6 7. ½.", "end.\r\nnext,\ttab...", "word*** 'quoted' dash-ed _under_. _", "\U0001F600! x?\u0301 y",
         "I'd. he's, 's 't", "q" * 5000 + " tail."]


def test_ids_are_those_of_whole_texts(whole, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", 50)
    monkeypatch.setattr(tokens, "TOGETHER", 40)
    encoder = tokens.TokenIds(vocabulary())
    texts = TEXTS + [words(i, 200, 3000) + "." for i in range(20)] + TEXTS
    assert list(encoder.encode(texts)) == [whole(t).tobytes() for t in texts]


def test_words_of_a_job_go_with_those_after():
    encoder = tokens.TokenIds(vocabulary())
    whole = list(encoder.encode(["some words"]))
    for job, known, older in (("a", 0, 2), ("a", 0, 2), ("b", 0, 0)):
        encoder.begin(job)
        assert (len(encoder._known), len(encoder._older)) == (known, older)
    assert list(encoder.encode(["some words"])) == whole


def test_ids_of_given_documents(spark, sf_dir, whole):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert list(tokens.TokenIds(vocabulary()).encode(texts)) == [whole(t).tobytes() for t in texts]


@pytest.mark.parametrize("lengths", [[], [1], [2048], [2049], [5000, 1], [1300], [700, 700, 700], [2047] * 5, list(range(1, 400)), [1] * 3000])
def test_windows(lengths):
    windows = packing.pack(lengths)
    seen = defaultdict(list)
    for window in windows:
        size = sum(n for _, _, n in window)
        assert size <= 2048 and size & (size - 1) == 0, "full windows or powers of two: no padding"
        for document, start, n in window:
            assert n > 0
            seen[document].append((start, n))
    for document, length in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[document]):
            assert start == at
            at += n
        assert at == length
    # the whole windows of long documents are their own, and short documents are rarely cut
    assert sum(len(p) > 1 for d, p in seen.items() if lengths[d] <= 1024) <= 2 * len(windows)


def test_balance():
    sizes = [2048] * 300 + [1024] * 111 + [512] * 77
    loads = defaultdict(int)
    for size, step in zip(sizes, packing.balance(sizes)):
        loads[step] += size
    assert max(loads.values()) - min(loads.values()) <= 2048


def test_packed_documents(odd, odd_rows, empty, whole, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCUMENTS", 4)
    rows = packing.pack_documents(odd, vocabulary(), with_ids=True).collect()
    ids = defaultdict(list)
    for d, t, _, _ in odd_rows:
        ids[d].append(np.append(whole(t), 1).astype("<u4").tobytes())
    sequences, covered = defaultdict(list), defaultdict(int)
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        assert any(own[4 * r.start:4 * (r.start + r.length)] == bytes(r.ids) and len(own) == 4 * r.doc_tokens for own in ids[r.doc_id])
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id] += r.length
    assert covered == {d: sum(len(own) // 4 for own in every) for d, every in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty, vocabulary()).count() == 0


@pytest.mark.parametrize("width", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 65_536])
def test_planes_round_trip(width, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    stored = planes.to_planes(ids, width)
    assert len(stored) == (4 if width == "byte" else 32)
    assert np.array_equal(planes.from_planes(stored, n, width), ids)


def test_crc_of_parts():
    data = bytes(range(256)) * 40
    for cut in (0, 1, 5, 4096, len(data)):
        assert planes.crc32_join(zlib.crc32(data[:cut]), zlib.crc32(data[cut:]), len(data) - cut) == zlib.crc32(data)


@pytest.mark.parametrize("width,chunk", [("byte", 64), ("bit", 1000), ("byte", 65_536)])
def test_files(spark, odd, odd_rows, whole, tmp_path, width, chunk):
    planes.write_ids(odd, str(tmp_path / "ids"), vocabulary(), chunk_ids=chunk, width=width)
    got = sorted(planes.read_digests(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    order = [r.doc_id for r in got]
    assert order == sorted((d for d, *_ in odd_rows if d is not None)) + [None, None]
    expected = defaultdict(list)
    for d, t, _, _ in odd_rows:
        own = np.append(whole(t), 2).astype("<u4")
        expected[d].append((len(own), zlib.crc32(own.tobytes())))
    at = 0
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in expected[r.doc_id]
        expected[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    assert not any(expected.values())
    assert sum(len(r.ids) for r in planes.read_ids(spark, str(tmp_path / "ids")).collect()) == at


def test_empty_file(spark, empty, tmp_path):
    planes.write_ids(empty, str(tmp_path / "ids"), vocabulary())
    assert planes.read_digests(spark, str(tmp_path / "ids")).count() == 0
