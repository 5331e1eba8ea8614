"""The posting lists of the neighbour search replicate and prune."""

from dataclasses import replace

import numpy as np

from tidemark.llm import neighbours
from tidemark.llm.neighbours import distances, fit, lists_of, measured_reach, probes_of, walk


def test_walks_find_the_nearest_centroids():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(5000, 8))
    lists = fit(points, len(points), 50)
    near, d = walk(lists, points[:300], neighbours.BEAM)
    exact = np.sqrt(distances(points[:300], lists.centroids))
    assert np.allclose(np.take_along_axis(exact, near, 1), d)
    assert (near[:, 0] == exact.argmin(1)).mean() > 0.99


def test_vectors_are_replicated_and_lists_pruned():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(50_000, 48))
    points /= np.linalg.norm(points, axis=1)[:, None]
    lists = fit(points[:20_000], len(points))
    held = []
    for lo in range(0, len(points), 256):
        held += lists_of(lists, points[lo : lo + 256])
    assert 1.2 < np.mean([len(x) for x in held]) <= neighbours.REPLICAS
    asked = np.arange(0, len(points), 400)
    d = distances(points[asked], points)
    d[np.arange(len(asked)), asked] = np.inf
    near = np.argsort(d, axis=1)[:, :10]
    tests = slice(0, 64)
    lists = replace(lists, reach=measured_reach(lists, points[asked[tests]], [points[n] for n in near[tests]]))
    probes = probes_of(lists, points[asked[64:]])
    assert np.mean([len(p) for p in probes]) < len(lists.centroids) / 10
    found = [any(i in set(p) for i in held[v]) for p, row in zip(probes, near[64:]) for v in row]
    assert np.mean(found) >= 0.9


def test_one_list():
    points = np.array([[1.0, 2.0], [3.0, 4.0]])
    lists = fit(points, 2)
    assert lists_of(lists, points) == [[0], [0]] and probes_of(lists, points) == [[0], [0]]
