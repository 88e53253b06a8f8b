"""Slices of Arrow batches and word hashes by chunks."""

import numpy as np
import pyarrow as pa

from relayout.llm import common


def test_slices_keep_every_row_in_order():
    batch = pa.record_batch({"t": ["x" * k for k in range(900)] + ["y" * 300_000, None, ""]})
    parts = list(common.slices(batch, 20_000))
    assert len(parts) > 10
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows == 1 or p.nbytes <= 20_000 for p in parts)
    data = b"".join(common.text_bytes(p.column(0))[0].tobytes() for p in parts)
    assert data == "".join(t or "" for t in batch.column(0).to_pylist()).encode()


def test_word_hashes_do_not_depend_on_chunks_or_neighbours(monkeypatch):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abC \t\n\xc3\xa9\x00", np.uint8)
    for _ in range(60):
        texts = [rng.choice(letters, int(rng.integers(0, 50))).tobytes() for _ in range(int(rng.integers(0, 6)))]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
        whole = common.word_hashes(data, offsets)
        assert whole[1].tolist() == [len(t.split()) for t in texts]
        alone = [common.word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0] for t in texts for w in t.split()]
        assert whole[0].tolist() == [int(h) for h in alone]
        monkeypatch.setattr(common, "CHUNK", int(rng.integers(1, 20)))
        assert common.word_hashes(data, offsets)[0].tolist() == whole[0].tolist()
        monkeypatch.undo()
