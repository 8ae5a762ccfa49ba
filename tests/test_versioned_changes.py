"""Versioned table (merge on read, untouched buckets, restart, expiry) and net changes."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from contentlake.operators import changes as ch
from contentlake.operators import mutate
from contentlake.sources.versioned import VersionedTable
from contentlake.streaming import streams

DOCS = ("repo string, id string, parent_id string, path string, name string, type string, state string, title string, "
        "locked boolean, trashed boolean, entity string, props string")
PLAIN = "seq bigint, kind string, doc_id string, parent_path string, name string, type string, title string, prop string, val string"


def docs(spark, n=40, repos=("default",)):
    rows = [(r, "root", None, "/", "", "Root", "project", "Root", False, False, "document", "{}") for r in repos]
    rows += [(r, f"d{i}", "root", f"/n{i}", f"n{i}", "Note", "project", f"N {i}", False, False, "document", json.dumps({"p:a": i}))
             for r in repos for i in range(n)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumn("properties", F.from_json("props", "map<string,variant>")).drop("props")


def rows(df):
    return sorted((r["repo"], r["id"], r["path"], r["title"], r["trashed"], r["p"]) for r in df.select(
        "repo", "id", "path", "title", "trashed", F.to_json("properties").alias("p")).collect())


def changes(spark, data):
    return spark.createDataFrame([tuple(x.get(c.split(" ")[0]) for c in PLAIN.split(", ")) for x in data], PLAIN)


def files(table):
    top = os.path.join(table.root.removeprefix("file:"), "files")
    return {os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.startswith("part-")}


def simulate(table, data):
    """Changes one after the other on a dict; results by seq."""
    state, start, outcome, owner = dict(table), dict(table), {}, {}
    paths = {v["path"]: k for k, v in start.items()}
    for x in sorted(data, key=lambda x: x["seq"]):
        kind, i = x["kind"], x.get("doc_id")
        if kind == "create":
            path = None if x.get("parent_path") is None or x.get("name") is None else ch_path(x["parent_path"], x["name"])
            i = i or "derived:" + str(path)
            if path is not None:
                owner.setdefault(path, i)
            if path is None:
                err = mutate.NO_NAME
            elif x["parent_path"] not in paths:
                err = mutate.PARENT_NOT_FOUND
            elif paths.get(path, i) != i:
                err = mutate.ALREADY_EXISTS
            elif owner[path] != i:
                err = mutate.DUPLICATE_IN_BATCH
            else:
                err = mutate.ALREADY_EXISTS if i in state else None
            if err is None:
                state[i] = {"path": path, "title": x.get("title") or x["name"], "trashed": False, "p": {"dc:title": x.get("title") or x["name"]}}
        elif kind not in ("update", "trash", "delete"):
            err = ch.UNKNOWN_KIND
        elif i is None:
            err = "no document reference"
        else:
            err = None if i in state else "document not found"
            if err is None and kind == "delete":
                del state[i]
            elif err is None and kind == "trash":
                state[i] = {**state[i], "trashed": True}
            elif err is None and x.get("prop") and x.get("val") is not None:
                state[i] = {**state[i], "p": {**state[i]["p"], x["prop"]: x["val"]}}
        outcome[x["seq"]] = err
    return state, outcome


def ch_path(parent, name):
    return "/" + name if parent == "/" else f"{parent}/{name}"


def as_dict(df):
    return {r["id"]: {"path": r["path"], "title": r["title"], "trashed": r["trashed"],
                      "p": {k: str(v) for k, v in json.loads(r["p"]).items()}}
            for r in df.select("id", "path", "title", "trashed", F.to_json("properties").alias("p")).collect()}


def mixed(seed, n, ids=14):
    r = random.Random(seed)
    out = []
    for seq in r.sample(range(10 * n), n):
        i = r.randrange(ids)
        x = {"seq": seq, "kind": r.choice(["create", "create", "update", "update", "trash", "delete", "delete", "move", None][:8 + (seq % 7 == 0)]),
             "doc_id": r.choice([f"d{i}", f"d{i}", f"x{i}"])}
        if x["kind"] == "create":
            x |= {"parent_path": r.choice(["/", "/", "/", "/nowhere", None]), "name": ("n" if x["doc_id"][0] == "d" else "x") + str(i),
                  "type": "Note", "title": r.choice([None, f"T{seq}"])}
            if r.random() < 0.1:
                x["name"] = "n3"          # a path that another document holds or takes
        if x["kind"] == "update":
            x |= {"prop": r.choice(["p:a", "p:b", None]), "val": r.choice(["x", "y", f"v{seq}", None])}
        if r.random() < 0.03:
            x["doc_id"] = None if x["kind"] != "create" else x["doc_id"]
        out.append(x)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_net_changes_equal_changes_one_by_one(spark, seed):
    table = docs(spark, 8)
    data = mixed(seed, 160)
    delta, results = ch.net_changes(table, changes(spark, data))
    state, outcome = simulate(as_dict(table), data)
    got = {r["seq"]: r["error"] for r in results.collect()}
    assert got == outcome
    out = {r["id"]: r for r in delta.collect()}
    assert len(out) == delta.count()
    after = {k: v for k, v in as_dict(table).items() if k not in out} | as_dict(delta.where("_op = 'put'"))
    assert after == state


def test_hot_document(spark):
    """A third of all changes on one document; the order decides."""
    data = [{"seq": i, "kind": "update", "doc_id": "d1" if i % 3 == 0 else f"d{i % 8}", "prop": f"p:{i % 5}", "val": str(i) + "v"} for i in range(3000)]
    data += [{"seq": 1500, "kind": "delete", "doc_id": "d1"}, {"seq": 1501, "kind": "create", "doc_id": "d1", "parent_path": "/", "name": "n1", "type": "Note"}]
    data = list({x["seq"]: x for x in data}.values())
    table = docs(spark, 8)
    delta, _ = ch.net_changes(table, changes(spark, data))
    state, _ = simulate(as_dict(table), data)
    assert as_dict(delta.where("_op = 'put'"))["d1"] == state["d1"]


def test_one_change_leaves_other_files_alone(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(docs(spark, 200, ("default", "a b/ü=1")), buckets=8)
    before = files(table)
    assert len(before) >= 14
    one = docs(spark, 1).where("id = 'd0'").withColumns({"title": F.lit("New"), "_op": F.lit("put")})
    table.commit(one)
    assert len(files(table) - before) == 1 and before <= files(table)
    table.compact()
    newest = table.manifest()
    assert not newest.changes and len([e for e in newest.base if e.folder.startswith("_commit=000000002")]) == 1
    assert newest.base_rows == 402 and table.read().count() == 402
    titles = {(r["repo"], r["id"]): r["title"] for r in table.read().collect()}
    assert titles["default", "d0"] == "New" and titles["a b/ü=1", "d0"] == "N 0"
    assert table.read(0).where("title = 'New'").count() == 0      # an old version stays as it was
    gone = table.expire(keep=1)
    assert len(gone) == 2 and table.versions() == [2] and table.read().count() == 402
    assert len(before - files(table)) == 1


def test_half_written_version_is_not_read(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(docs(spark, 5), buckets=2)
    rows_ = docs(spark, 5).withColumns({"title": F.lit("Lost"), "_repo": F.col("repo"), "_bucket": F.lit(-1), "_op": F.lit("put")})
    table._write(rows_, 1)          # files without a manifest: the writer died
    assert table.versions() == [0] and table.read().where("title = 'Lost'").count() == 0
    stale = table.manifest()
    table.commit(docs(spark, 1).withColumn("_op", F.lit("put")))
    with pytest.raises(RuntimeError):   # a second writer that began from the same version
        table._publish(type(stale)(1, stale.buckets, stale.schema, {}, stale.base, ()))


def test_puts_deletes_folds_and_empty_batches(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    base = docs(spark, 20)
    table.create(base, buckets=4)
    put = lambda i, title: docs(spark, 20).where(f"id = 'd{i}'").withColumns({"title": F.lit(title), "_op": F.lit("put")})
    delete = lambda i: put(i, None).withColumn("_op", F.lit("delete"))
    table.commit(put(1, "one").unionByName(delete(2)))
    table.commit(delete(1).unionByName(put(2, "two")).unionByName(put(3, "three")))
    table.commit(put(4, "x").limit(0))
    expected = rows(table.read())
    titles = {r[1]: r[3] for r in expected}
    assert "d1" not in titles and titles["d2"] == "two" and titles["d3"] == "three" and len(titles) == 20
    table.fold()
    assert len(table.manifest().changes) == 1 and rows(table.read()) == expected
    table.compact()
    assert rows(table.read()) == expected and not table.manifest().changes
    empty = VersionedTable(spark, str(tmp_path / "empty"))
    empty.create(base.limit(0))
    assert empty.read().count() == 0
    empty.commit(put(1, "first"))
    assert rows(empty.compact() and empty.read())[0][1] == "d1"


def test_stream_of_changes_with_restarts(spark, tmp_path):
    source, checkpoint, results = (str(tmp_path / x) for x in ("in", "ckpt", "results"))
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(docs(spark, 8), buckets=4)
    state = as_dict(table.read())
    for b in range(4):
        data = mixed(10 + b, 40)
        changes(spark, data).coalesce(1).write.mode("append").parquet(source)
        before = files(table)
        stream = streams.read_stream(spark, source)
        streams.stream_changes(spark, stream, table, results, checkpoint, share=10.0, most=2)
        state, outcome = simulate(state, data)
        assert as_dict(table.read()) == state
        got = {r["seq"]: r["error"] for r in spark.read.parquet(os.path.join(results, f"batch={b}")).collect()}
        assert got == outcome
        assert before <= files(table)
    version = table.manifest().version
    assert len(table.manifest().changes) <= 3
    # a batch that is replayed after its commit does nothing
    table.commit(docs(spark, 1).withColumn("_op", F.lit("delete")), (checkpoint, 3))
    assert table.manifest().version == version
    # nothing new: nothing written
    streams.stream_changes(spark, streams.read_stream(spark, source), table, results, checkpoint)
    assert table.manifest().version == version
    # compacted at once, old versions dropped: the files are those of one table
    changes(spark, mixed(20, 40)).coalesce(1).write.mode("append").parquet(source)
    streams.stream_changes(spark, streams.read_stream(spark, source), table, results, checkpoint, share=0.0, keep=1)
    state, _ = simulate(state, mixed(20, 40))
    assert as_dict(table.read()) == state
    assert len(table.versions()) == 1 and not table.manifest().changes
    assert {e.folder for e in table.manifest().base} == {os.path.relpath(os.path.dirname(f), os.path.join(table.root, "files")) for f in files(table)}


def test_bytes_written_follow_the_batch(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(docs(spark, 20_000), buckets=4)
    size = lambda fs: sum(os.path.getsize(f) for f in fs)
    base = files(table)
    table.commit(docs(spark, 10).where("id <> 'root'").withColumn("_op", F.lit("put")))
    assert size(files(table) - base) < size(base) / 20


def test_repository_filter_prunes_folders(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(docs(spark, 50, ("default", "archive", "third")), buckets=2)
    requests = spark.createDataFrame([("archive", "d1")], "r string, d string")
    joined = table.read().join(F.broadcast(requests), (F.col("repo") == F.col("r")) & (F.col("id") == F.col("d")))
    assert joined.count() == 1
    plan = table.read().where("repo = 'archive'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_repo" in plan
