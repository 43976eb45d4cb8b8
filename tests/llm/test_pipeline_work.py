"""Work of the pipeline's stages that must not grow faster than their input."""

import numpy as np
import pyarrow as pa

from docweave.llm import anchors, parity


def _table(sketches, sizes):
    n = len(sketches)
    return pa.table(
        {
            "sid": pa.array([i.to_bytes(16, "big") for i in range(n)], pa.binary()),
            "meta": pa.array([np.int64(s).tobytes() + w.tobytes() for s, w in zip(sizes, sketches)], pa.binary()),
            "cell": pa.array(np.zeros(n, np.int64)),
        }
    )


def _brute(sketches, sizes, bands):
    up = list(range(len(sketches)))
    for i in range(len(up)):
        for j in range(i):
            small, large = sorted((int(sizes[i]), int(sizes[j])))
            far = int(np.bitwise_count(sketches[i] ^ sketches[j]).sum())
            if 100 * small >= bands.percent * large and far <= bands.apart(small):
                a, b = up[i], up[j]
                up = [min(a, b) if u in (a, b) else u for u in up]
    return {(i, u) for i, u in enumerate(up) if i != u}


def test_sets_with_one_common_block_meet_in_few_steps(monkeypatch):
    """Once each set of a group looked at all others one by one."""
    bands, rng, calls = parity.Bands(80), np.random.default_rng(5), []
    count = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: calls.append(len(x)) or count(x))
    for blocks in (4, 5, 121):
        sketches = rng.integers(0, 1 << 16, (300, blocks), dtype=np.uint16)
        sizes = np.full(300, 8 * blocks)
        calls.clear()
        got = parity._linked(_table(sketches, sizes), bands)
        assert len(calls) < 150
        want = _brute(sketches, sizes, bands)
        assert {(int.from_bytes(a, "big"), int.from_bytes(b, "big")) for a, b in zip(*got.to_pydict().values())} == want
    # Chains and groups of copies among others, in no order, sizes too far apart among them.
    sketches = rng.integers(0, 1 << 16, (30, 40), dtype=np.uint16)[rng.integers(0, 30, 400)]
    sketches[np.arange(400), rng.integers(0, 40, 400)] ^= rng.integers(0, 1 << 16, 400, dtype=np.uint16)
    sizes = rng.integers(60, 90, 400)
    got = parity._linked(_table(sketches, sizes), bands)
    assert {(int.from_bytes(a, "big"), int.from_bytes(b, "big")) for a, b in zip(*got.to_pydict().values())} == _brute(sketches, sizes, bands)


def test_cut_texts_are_shuffled_once(spark):
    """Columns of the caller pass through; only the answers' shuffle and that of the rows are left."""
    words = [f"w{i}" for i in range(200)]
    rows = [
        (1, " ".join(words[:120]), "a", 5, None),
        (2, " ".join(words[40:]) + "  tail\n", "b", 5, {"k": 1}),
        (2, " ".join(words[40:]) + "  tail\n", "c", 5, None),
        (3, " \t", "d", 5, None), (4, None, "e", 5, None), (None, "few  words ", "f", 5, {}),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string, n_chars int, _cut map<string,int>")
    out = anchors.cut_repeats(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = sorted((tuple(r) for r in out.collect()), key=lambda r: r[2])
    kept = " ".join(words[120:]) + "  tail\n"
    assert got == [
        rows[0], (2, kept, "b", len(kept), {"k": 1}), (2, kept, "c", len(kept), None), rows[3], rows[4], rows[5],
    ]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "first(text" not in plan and plan.count("Join ") == 1
