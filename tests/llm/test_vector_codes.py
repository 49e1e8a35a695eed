"""Codes against a brute force in plain integers; trees, copies, ties, odd rows."""
import hashlib
import math

import numpy as np
import pytest

from barlake.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, spot string, code int"


def slow(rows, entries=vc.ENTRIES):
    """(vec_id, code, error, label_error, codebooks_sha256) by exact comparisons."""
    kept = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[[math.floor(1024 * x) for x in v[p * len(v) // 4:(p + 1) * len(v) // 4]] for p in range(4)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(4)]

    def nearest(part, book):
        d = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return d.index(min(d)), min(d)
    for _ in range(4):
        for p in range(4):
            got = {}
            for c in cut:
                got.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            books[p] = [[sum(x) // len(got[e]) for x in zip(*got[e])] if e in got else old for e, old in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(4)] for c in cut]
    label = {}
    for (_, _, lab), f in zip(kept, found):
        label[lab] = label.get(lab, 0) + sum(d for _, d in f)
    return sorted([(i, "".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f), label[lab], digest)
                   for (i, _, lab), f in zip(kept, found)], key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA).repartition(parts)


def floats(x):
    return [float(np.float32(y)) for y in x]


@pytest.mark.parametrize("entries,block", [(256, 1024), (5, 16)])
def test_equals_brute_force(spark, monkeypatch, entries, block):
    monkeypatch.setattr(vc, "ENTRIES", entries)
    monkeypatch.setattr(vc, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), floats(centres[i % 6] * 0.3 + rng.normal(size=8) * 0.02), int(i % 3)) for i in range(120)]
    rows += [(500 + i, floats(centres[0]), 9) for i in range(60)]  # a group of copies
    rows += [(600 + i, floats(np.round(rng.normal(size=8))), None) for i in range(40)]  # ties
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (None, rows[3][1], 2)]
    odd = [(900, None, 1), (901, [], 1), (902, [1.0, None] * 4, 1), (903, [float("nan")] * 8, 1), (904, [float("inf")] * 8, None)]
    got = sorted(map(tuple, vc.compressed(frame(spark, rows + odd)).collect()), key=str)
    assert got == slow(rows + odd, entries) and len(got) == len(rows)


def test_few_rows_and_none(spark):
    assert vc.compressed(frame(spark, [(1, None, 1)], 1)).collect() == []
    rows = [(2, [0.5, -0.5, 0.001, -0.001], 1), (1, [0.1] * 4, None)]
    assert sorted(map(tuple, vc.compressed(frame(spark, rows)).collect()), key=str) == slow(rows)


def test_mixed_lengths_are_refused(spark):
    with pytest.raises(Exception, match="one length"):
        vc.compressed(frame(spark, [(1, [0.1] * 4, 1), (2, [0.1] * 8, 1)])).collect()


def test_tree_covers_and_parts():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.integers(-300, 300, (300, 4)), np.zeros((50, 4), np.int64)])
    tree, spot = vc.CoverTree.build(rows)
    assert (tree.points[spot] == rows).all() and tree.weight.sum() == len(rows)
    for (lo, hi, first, children), radius in zip(tree.nodes, tree.radius):
        apart = np.sqrt(((tree.points[lo:hi] - tree.points[lo]) ** 2).sum(1))
        assert apart.max() <= radius
        if children:
            starts, stops = tree.nodes[first:first + children, :2].T
            assert starts[0] == lo and stops[-1] == hi and (starts[1:] == stops[:-1]).all()
            heads = tree.points[starts]
            gaps = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(2)) + np.eye(children) * 1e9
            assert gaps.min() > radius / 2 and tree.radius[first:first + children].max() <= radius / 2


def test_subtrees_are_settled_whole():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.integers(-9, 9, (200, 4)) + c for c in (0, 5000)])
    tree, _ = vc.CoverTree.build(rows)
    steps = list(tree.owners(np.array([[0] * 4, [5000] * 4])))
    assert sum(len(lo) for lo, _, _ in steps) == 2  # each cluster by one comparison of its node
    wide = np.array([[2 ** 29, 0, 0, 0]])
    assert vc.squared(wide, -wide)[0, 0] == 2 ** 60
