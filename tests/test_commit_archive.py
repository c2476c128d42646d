"""Fenced commits, ledger-driven archive, published tables, copy on write, and what scratch data holds."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tillstar.operators import flat as FL
from tillstar.operators import rows as R
from tillstar.plans import staging
from tillstar.plans.claim import LoadInProgress
from tillstar.plans.load import Warehouse, load_batch
from tillstar.session import list_dir, move, publish_file
from tillstar.sources import csv as C
from tillstar.streaming import ingest as I

TABLES = ["stores", "customers", "products", "flavours", "transactions", "baskets"]


def sales(path, store, n, start=1):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for d in range(start, start + n):
            f.write(f'{d:02}-02-2024 09:00:00,{store},Cus {store} {d},"Tea {store} - 1.30, Bun - 2.00",3.30,CASH,\n')
    return path


def state(wh):
    return {t: sorted(map(str, wh.read(t).collect())) for t in TABLES}


def whole(wh, n):
    assert sorted(r.transaction_id for r in wh.read("transactions").collect()) == list(range(1, n + 1))
    assert wh.read("baskets").count() == 2 * n
    for child, key, parent in (("transactions", "customer_id", "customers"), ("baskets", "product_id", "products")):
        assert wh.read(child).join(wh.read(parent), key, "left_anti").count() == 0


def test_publish_file_creates_once(spark, tmp_dir):
    assert publish_file(spark, f"{tmp_dir}/x.json", "first")
    assert not publish_file(spark, f"{tmp_dir}/x.json", "second")
    assert open(f"{tmp_dir}/x.json").read() == "first" and os.listdir(tmp_dir) == ["x.json"]


@pytest.mark.parametrize("stalled_first", [True, False])
def test_a_load_that_stalls_before_its_commit(spark, tmp_dir, monkeypatch, stalled_first):
    """Load A stalls after its claim was checked; B takes the claim, loads and commits; one of them counts."""
    feeds = {n: sales(f"{tmp_dir}/{n}/raw.csv", n, k) for n, k in (("East", 4), ("West", 6))}
    root = f"{tmp_dir}/wh"
    wh, other = Warehouse(spark, root).bootstrap(), Warehouse(spark, root)
    commit = Warehouse.commit
    begun = []

    def stalling(self, batch_id, source, max_ids):
        if self is wh and not begun:
            begun.append(batch_id)
            os.remove(f"{root}/_claim")  # as if it had not been renewed for long
            if not stalled_first:
                commit(self, batch_id, source, max_ids)  # A goes on before B commits
            load_batch(other, C.read_raw_csv(spark, feeds["West"]), batch_id, source="b")
        if not (self is wh and begun and not stalled_first):
            commit(self, batch_id, source, max_ids)

    monkeypatch.setattr(Warehouse, "commit", stalling)
    if stalled_first:
        with pytest.raises(LoadInProgress):
            load_batch(wh, C.read_raw_csv(spark, feeds["East"]), 1, source="a")
        expect, n = "West", 6
    else:
        load_batch(wh, C.read_raw_csv(spark, feeds["East"]), 1, source="a")
        expect, n = "East", 4
    assert [r.store_name for r in other.read("stores").collect()] == [expect]
    whole(other, n)
    monkeypatch.setattr(Warehouse, "commit", commit)
    load_batch(other, C.read_raw_csv(spark, feeds["East" if expect == "West" else "West"]), source="c")
    whole(other, 10)
    assert sorted(r.batch_id for r in other.ledger().collect()) == [1, 2]


def test_attempts_of_one_batch_never_mix(spark, tmp_dir):
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    a, b = sales(f"{tmp_dir}/a/raw.csv", "North", 5), sales(f"{tmp_dir}/b/raw.csv", "South", 3)
    load_batch(wh, C.read_raw_csv(spark, a), 1, commit=False)
    assert all(not rows for rows in state(wh).values())
    load_batch(wh, C.read_raw_csv(spark, b), 1)
    whole(wh, 3)
    assert [r.store_name for r in wh.read("stores").collect()] == ["South"]
    for t in TABLES:  # the lost attempt's files are gone
        assert wh._raw(t).select("batch_id", "attempt").distinct().count() == 1


CARD = "4444000011112222"


def test_no_written_table_holds_names_or_cards(spark, tmp_dir, monkeypatch):
    """Every file of the warehouse right before the commit, scratch included."""
    line = ["01-02-2024 09:01:00", "Leeds", "Ann Ode", '"Tea - 1.30"', "1.30", "CARD", CARD]
    lines = [",".join(line)]
    lines += [",".join(line[:n] + line[n + 1 :]) for n in range(7)]
    lines += [",".join(line[:n] + [""] + line[n:]) for n in range(7)]
    lines += [",".join(["01-02-2024 09:01:00", "Ann Ode", "x", '"Tea - Ann Ode"', "1.30", CARD, "CARD"]), ",".join(["Ann Ode"] * 7)]
    with open(f"{tmp_dir}/raw.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    seen = []
    commit = Warehouse.commit

    def look(self, *args):
        folders = {os.path.dirname(p) for p in glob.glob(f"{tmp_dir}/wh/**/*.parquet", recursive=True)}
        for folder in folders:
            seen.extend(str(v) for row in spark.read.parquet(folder).collect() for v in row)
        commit(self, *args)

    monkeypatch.setattr(Warehouse, "commit", look)
    load_batch(wh, C.read_raw_csv(spark, f"{tmp_dir}/raw.csv"), 1)
    assert len(seen) > 100 and not [v for v in seen if CARD in v or "Ann Ode" in v]
    import hashlib

    digest = hashlib.md5(CARD.encode()).hexdigest()
    assert digest not in seen


def test_line_digests_are_stable(spark, tmp_dir):
    with open(f"{tmp_dir}/raw.csv", "w") as f:
        f.write("short,row\nother,row,here\n")
    raw = C.read_raw_csv(spark, f"{tmp_dir}/raw.csv")
    digests = []
    for batch in (1, 2):
        wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()  # as another process would
        load_batch(wh, raw, batch)
        digests.append(sorted(r.line_md5 for r in wh.batch_rows("quarantine", batch).collect()))
    assert digests[0] == digests[1] and len(set(digests[0])) == 2
    another = Warehouse(spark, f"{tmp_dir}/wh2").bootstrap()
    load_batch(another, raw, 1)
    assert sorted(r.line_md5 for r in another.read("quarantine").collect()) != digests[0]
    assert staging.stage(raw).where(F.col("store_name").isNotNull()).count() == 0


def archived(path):
    return sorted(os.path.relpath(p, path) for p in glob.glob(f"{path}/**/*.csv", recursive=True))


def test_archive_follows_the_ledger(spark, tmp_dir, monkeypatch):
    wh = Warehouse(spark, f"{tmp_dir}/wh").bootstrap()
    inbox, archive, ckpt = f"{tmp_dir}/in box", f"{tmp_dir}/archive", f"{tmp_dir}/ckpt"
    sales(f"{inbox}/a b.csv", "East", 3)
    I.run_available(spark, inbox, wh, ckpt, archive_dir=archive)
    assert archived(archive) == ["a b.csv"] and archived(inbox) == []

    # a run lost between its commit and the move
    sales(f"{inbox}/c.csv", "West", 2)
    sales(f"{inbox}/d.csv", "West", 2, start=5)

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(I, "move", lost)
    with pytest.raises(OSError):
        I.run_available(spark, inbox, wh, ckpt, archive_dir=archive)
    assert archived(inbox) == ["c.csv", "d.csv"]
    monkeypatch.setattr(I, "move", move)
    sales(f"{inbox}/e.csv", "West", 1, start=9)
    I.run_available(spark, inbox, wh, ckpt, archive_dir=archive)
    assert archived(archive) == ["a b.csv", "c.csv", "d.csv", "e.csv"] and archived(inbox) == []
    whole(wh, 8)
    assert list_dir(spark, wh.path("_files")) == []

    # files of a batch that is not committed stay
    sales(f"{inbox}/f.csv", "West", 1, start=11)
    monkeypatch.setattr(Warehouse, "commit", lost)
    with pytest.raises(Exception):
        I.run_available(spark, inbox, wh, ckpt, archive_dir=archive)
    assert archived(inbox) == ["f.csv"]


def flat_of(spark, tmp_dir, items):
    rows = [(n, "01-02-2024 09:00:00", "North", "Ann", ",".join(items), 1.0, "CASH", None) for n in range(3)]
    cols = "o_orderkey long, timestamp string, store string, customer_name string, basket_items string, total_price double, cash_or_card string, card_number string"
    return FL.flat_frame(spark.createDataFrame(rows, cols), f"{tmp_dir}/flat{len(items)}", keep_order=True)


def test_a_conflict_leaves_every_published_table(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/out"
    FL.write_flat_tables(flat_of(spark, tmp_dir, ["Tea - 1.30"]), out, f"{tmp_dir}/s1")
    read = lambda: {t: sorted(map(str, spark.read.parquet(f"{out}/{t}").collect())) for t in FL.FLAT_TABLES}
    before = read()
    more = flat_of(spark, tmp_dir, ["Tea - 1.30", "Bun - 2.00"])
    twice = FL.flavours_table
    monkeypatch.setattr(FL, "flavours_table", lambda *a: twice(*a).union(twice(*a)))
    with pytest.raises(FL.KeyConflictError, match="flavours"):
        FL.write_flat_tables(more, out, f"{tmp_dir}/s2")
    assert read() == before and not os.path.exists(f"{out}/{FL.STAGED}")
    monkeypatch.setattr(FL, "flavours_table", twice)

    # lost while publishing: the marker decides, and the next call completes it
    moves = []

    def failing(spark_, source, target):
        if len(moves) == 3:
            raise OSError("lost")
        moves.append(target)
        return move(spark_, source, target)

    monkeypatch.setattr(FL, "move", failing)
    with pytest.raises(OSError):
        FL.write_flat_tables(more, out, f"{tmp_dir}/s3")
    monkeypatch.setattr(FL, "move", move)
    assert FL.finish_publication(spark, out) and not FL.finish_publication(spark, out)
    after = read()
    assert len(after["products"]) == 2 and len(after["orders"]) == 6
    assert sorted(os.listdir(out)) == sorted(FL.FLAT_TABLES)


def test_update_files_writes_only_touched_files(spark, tmp_dir):
    df = spark.range(1000).selectExpr("id as k", "concat('n', id) as a", "id * 2 as b")
    df.repartitionByRange(10, "k").write.parquet(f"{tmp_dir}/a b")
    upd = spark.createDataFrame([(5, None, 7), (5, "x", 1), (6, "y", None), (420, "z", 0), (5000, "w", 1)], "k long, a string, b long")
    done = R.update_files(spark, f"{tmp_dir}/a b", upd, ["k"], ["a", "b"], f"{tmp_dir}/new")
    assert len(done.touched) == 2 and len(done.kept) == 8
    assert spark.read.parquet(done.written).count() < 300
    got = {r.k: (r.a, r.b) for r in done.frame.collect()}
    assert len(got) == 1000 and got[5] == (None, 7) and got[6] == ("y", None) and got[420] == ("z", 0) and got[7] == ("n7", 14)
    none = R.update_files(spark, f"{tmp_dir}/a b", upd.where("k = 5000"), ["k"], ["a", "b"], f"{tmp_dir}/new2")
    assert none.touched == [] and none.frame.count() == 1000 and not os.path.exists(f"{tmp_dir}/new2")
