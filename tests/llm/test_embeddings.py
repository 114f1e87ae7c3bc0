from __future__ import annotations

import os
import threading
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from rankweave.llm import embeddings
from rankweave.llm.embeddings import Quantiser, fit_quantiser, in_lists, link_embeddings, linked_in_list, sketch
from rankweave.runtime import shared_folder


def vectors(n=600, width=32):
    rng = np.random.RandomState(2)
    centres = rng.standard_normal((40, width))
    rows = [(i, (centres[i % 40] + rng.standard_normal(width) * rng.choice([0.05, 0.25, 0.35])).tolist()) for i in range(n)]
    hub = rng.standard_normal(width)
    rows += [(n + i, (hub + 0.1 * rng.standard_normal(width)).tolist()) for i in range(200)]
    rows += [(2000 + i, rows[3][1]) for i in range(20)] + [(2100, (np.array(rows[3][1]) * 7).tolist())]
    return rows


def by_hand(rows):
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    ids = np.array([i for i, _ in rows])
    least = ids.copy()
    for _ in range(len(rows)):
        new = np.minimum(least, np.where(near, least[None, :], 10**9).min(1))
        if (new == least).all():
            break
        least = new
    return near.sum(1), least


@pytest.mark.parametrize("block", [512, 40])
def test_recall_and_no_false_link(spark, block):
    rows = vectors()
    bad = [(3000, None), (3001, [0.0] * 32), (3002, [None] + [1.0] * 31), (3003, [float("nan")] + [1.0] * 31), (3004, [float("inf")] + [1.0] * 31), (3005, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows + bad], "vec_id bigint, embedding array<float>, cls int, n_links int")
    rows = [(i, np.array(v, dtype=np.float32).astype(float).tolist()) for i, v in rows]
    found = {r["vec_id"]: r for r in link_embeddings(df, list_size=50, block=block).collect()}
    assert len(found) == len(rows) + len(bad)
    degree, component = by_hand(rows)
    got = np.array([found[i]["n_links"] for i, _ in rows])
    assert (got <= degree).all() and got.sum() >= 0.98 * degree.sum()
    assert np.mean([found[i]["component_id"] == c for (i, _), c in zip(rows, component)]) > 0.95
    assert all((found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True) for i, _ in bad)


def test_table_lookup_loses_nothing_within_a_list():
    rng = np.random.RandomState(0)
    x = rng.standard_normal((300, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[150:] = x[:150] + 0.05 * rng.standard_normal((150, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = fit_quantiser(x, 1)
    codes, error = q.encode(x - q.coarse[0])
    a, b = linked_in_list(Quantiser(q.coarse, q.fine, q.cuts), 0, x, x, codes, error, 0.9)
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*(k.tolist() for k in np.nonzero(np.einsum("id,jd->ij", x, x) >= 0.9))))


def test_empty_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert link_embeddings(spark.createDataFrame([], schema)).collect() == []
    assert [tuple(r) for r in link_embeddings(spark.createDataFrame([(4, None)], schema)).collect()] == [(4, 0, 4, True)]
    two = spark.createDataFrame([(4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [2.0, 0.0])], schema)
    assert sorted(map(str, ((r["vec_id"], r["n_links"], r["component_id"]) for r in link_embeddings(two).collect()))) == ["(4, 2, 4)", "(4, 2, 4)", "(None, 2, 4)"]


def test_a_dense_group_of_different_vectors_keeps_its_links(spark):
    rng = np.random.RandomState(4)
    centre = rng.standard_normal(32)
    centre /= np.linalg.norm(centre)
    dense = centre + rng.choice([0.2, 0.3, 0.4], (600, 1)) * rng.standard_normal((600, 32)) / np.sqrt(32)
    # Each vector may ask 12 lists, and the group alone is cut into more than 50.
    rows = [(i, v.tolist()) for i, v in enumerate([*dense, *rng.standard_normal((600, 32))])]
    found = {r["vec_id"]: r for r in link_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), list_size=10).collect()}
    degree, component = by_hand(rows)
    assert degree[:600].sum() > 100_000
    assert [found[i]["n_links"] for i in range(600)] == degree[:600].tolist()
    assert [found[i]["component_id"] for i in range(600)] == component[:600].tolist()


def test_vectors_of_each_length_have_their_links(spark):
    rng = np.random.RandomState(8)
    rows = []
    for width, count in ((32, 300), (8, 120), (5, 2), (3, 1)):
        centres = rng.standard_normal((max(1, count // 4), width))
        rows += [(centres[k % len(centres)] + 0.05 * rng.standard_normal(width)).tolist() for k in range(count)]
    rows = list(enumerate(rows))
    found = {r["vec_id"]: r for r in link_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), list_size=50).collect()}
    for width in (32, 8, 5, 3):
        same = [(i, v) for i, v in rows if len(v) == width]
        degree, component = by_hand(same)
        assert sum(found[i]["n_links"] for i, _ in same) >= 0.98 * degree.sum()
        assert all(found[i]["n_links"] <= d for (i, _), d in zip(same, degree))
        assert np.mean([found[i]["component_id"] == c for (i, _), c in zip(same, component)]) > 0.95


def test_measuring_many_lists_takes_bounded_memory():
    import tracemalloc

    rng = np.random.RandomState(9)
    unit = rng.standard_normal((4000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    q = Quantiser(unit[rng.permutation(4000)][:3000], np.zeros((8, 4, 8)), np.linspace(0, 64, 9).astype(int))
    tracemalloc.start()
    lists = q.probed_lists(unit, 12, 0.9)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()
    assert len(lists) == 4000 and min(map(len, lists)) >= 12
    nearest = (unit[:50] @ q.coarse.T).argmax(1)
    assert [asked[0] for asked in lists[:50]] == nearest.tolist()


def test_disk_follows_the_vectors_and_not_what_they_ask(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PASS_BYTES", 0, raising=False)
    rng = np.random.RandomState(6)
    x = rng.standard_normal((12_000, 64)).astype(np.float32)
    x[::2] = x[1::2] + 0.02 * rng.standard_normal((6_000, 64)).astype(np.float32)
    rows = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, 64, dtype=np.int32)), pa.array(x.ravel()))})
    table = spark.createDataFrame(rows)
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [*local, shared_folder(spark).removeprefix("file://")]

    def used():
        total = 0
        for folder in folders:
            for file in Path(folder).rglob("*"):
                if not file.name.startswith("broadcast"):
                    try:
                        total += os.stat(file).st_size if file.is_file() else 0
                    except OSError:
                        pass
        return total

    before, most, ended = used(), [0], threading.Event()

    def watch():
        while not ended.wait(0.02):
            most[0] = max(most[0], used() - before)

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        found = link_embeddings(table).where("n_links > 0").count()
    finally:
        ended.set()
        watching.join()
    assert found == len(x)
    # Each vector asks 12 of 60 lists. What does not follow the vectors is the ends of small files.
    assert most[0] < 8 * x.nbytes


@pytest.mark.parametrize("kind", ["float", "double"])
def test_passes_and_parts_of_lists_lose_no_link_in_a_dense_group(spark, monkeypatch, kind):
    monkeypatch.setattr(embeddings, "PASS_BYTES", 0, raising=False)
    rng = np.random.RandomState(10)
    centre = rng.standard_normal(24)
    dense = centre / np.linalg.norm(centre) + rng.choice([0.2, 0.35], (500, 1)) * rng.standard_normal((500, 24)) / np.sqrt(24)
    x = np.concatenate([dense, 3 * dense[:40], rng.standard_normal((300, 24))])
    x = x.astype(np.float32).astype(float) if kind == "float" else x
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    schema = f"vec_id bigint, embedding array<{kind}>"
    found = {r["vec_id"]: r for r in link_embeddings(spark.createDataFrame(rows, schema), list_size=20, block=60).collect()}
    degree, component = by_hand(rows)
    assert [found[i]["n_links"] for i in range(540)] == degree[:540].tolist()
    assert [found[i]["component_id"] for i in range(540)] == component[:540].tolist()
    assert all(found[i]["n_links"] <= degree[i] for i in range(len(rows)))


def test_sketches_are_as_near_as_they_say():
    rng = np.random.RandomState(11)
    x = rng.standard_normal((200, 48)) * np.where(rng.rand(200, 48) < 0.03, 40, 1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    whole, scale, off = sketch(x)
    assert whole.dtype == np.int8
    assert (np.linalg.norm(x - whole * scale[:, None].astype(float), axis=1) <= off).all() and off.max() < 0.05


def test_look_up_is_the_distance_to_what_the_codes_stand_for():
    rng = np.random.RandomState(12)
    x = rng.standard_normal((150, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = fit_quantiser(x, 3)
    codes, error = q.encode(x - q.coarse[1])
    decoded = q.coarse[1] + np.concatenate([q.fine[s][codes[:, s], : b - a] for s, (a, b) in enumerate(zip(q.cuts, q.cuts[1:]))], axis=1)
    exact = ((x[None, :, :] - decoded[:, None, :]) ** 2).sum(2)
    assert np.abs(q.lookup(x, 1, codes) - exact).max() < embeddings.slack(20)
    assert np.allclose(np.sqrt(((x - decoded) ** 2).sum(1)), error)


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_entries_of_a_list_come_together_and_queries_as_they_are_read(size):
    rows = [(1, True, 10), (1, True, 11), (1, False, 12), (1, False, 13), (2, False, 14), (3, True, 15), (5, True, 16), (5, True, 17), (5, False, 18), (6, True, 19)]
    whole = pa.table({n: pa.array(c) for n, c in zip(("list", "entry", "cls"), zip(*rows))})
    got = {}
    for place, entries, queries in in_lists(iter(whole.to_batches(max_chunksize=size))):
        if entries is not None:
            assert place not in got
            got[place] = (entries.column("cls").to_pylist(), [])
        if queries is not None:
            got[place][1].extend(queries.column("cls").to_pylist())
    assert got == {1: ([10, 11], [12, 13]), 3: ([15], []), 5: ([16, 17], [18]), 6: ([19], [])}
