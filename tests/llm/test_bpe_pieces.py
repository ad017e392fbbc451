"""Merged pieces that the codec keeps."""

from vigil.llm.bpe import PairIndexCodec, tokenizer_path


def test_a_piece_is_merged_once_whatever_stands_around_it(monkeypatch):
    codec, merged = PairIndexCodec(tokenizer_path()), []
    merge = codec.merge
    monkeypatch.setattr(codec, "merge", lambda pieces: merged.extend(pieces) or merge(pieces))
    first = codec.encode_block([b"Reading readings"])[0]
    again = codec.encode_block([b"reading, (READINGS) Reading", None, b""])
    assert len(merged) == len(set(merged)) and {"reading", "readings"} <= set(merged)
    fresh = PairIndexCodec(tokenizer_path())
    assert again == fresh.encode_block([b"reading, (READINGS) Reading", None, b""]) and first == fresh.encode_block([b"Reading readings"])[0]


def test_pieces_kept_are_bounded(monkeypatch):
    monkeypatch.setattr("vigil.llm.bpe.KEPT_PIECES", 10)
    codec = PairIndexCodec(tokenizer_path())
    texts = [" ".join(f"w{i}x{k}" for k in range(20)).encode() for i in range(30)]
    got = [codec.encode_block([t])[0] for t in texts]
    assert got == PairIndexCodec(tokenizer_path()).encode_block(texts) and len(codec.young) + len(codec.aged) < 200
