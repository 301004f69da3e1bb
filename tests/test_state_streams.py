"""Order timers in runs, the chained dashboard, as-of versions."""

import datetime as dt
import decimal
import random
import types

import pytest

from tidewater.operators import scan, versions
from tidewater.streaming import dashboard_stream, processors

# --- order timers: the processor on plain dictionaries instead of a state store ---


class Store:
    """State handle that counts what a processor reads."""

    def __init__(self):
        self.value, self.map, self.timers, self.read = None, {}, set(), 0

    def getValueState(self, name, schema):
        return types.SimpleNamespace(get=lambda: self.value, update=self._update, clear=lambda: self._update(None))

    def getMapState(self, name, key, value):
        return types.SimpleNamespace(getValue=self._get, updateValue=self.map.__setitem__, removeKey=self.map.pop)

    def _update(self, v):
        self.value = v

    def _get(self, k):
        self.read += len(self.map[k][0])
        return self.map[k]

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


def drive(orders, interval, batch, timers_first=False):
    """``orders`` (id, created, reviewed) by batches of ``batch`` rows through the processor; the watermark is the newest
    creation before the batch. Returns the actions and the state."""
    p, store = processors.OrderTimeout("id", "created", "reviewed", interval), Store()
    p.init(store)
    clock, out = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), []
    mark = 0

    def fire():
        for t in sorted(t for t in store.timers if t <= mark):
            store.timers.discard(t)
            out.extend(p.handleExpiredTimer(("u",), clock, types.SimpleNamespace(getExpiryTimeInMs=lambda t=t: t)))
    for lo in range(0, len(orders), batch):
        rows = [{"id": o[0], "created": o[1], "reviewed": o[2]} for o in orders[lo:lo + batch]]
        out.extend(p.handleInputRows(("u",), iter(rows), clock))
        fire()
        mark = max(mark, max(r["created"] for r in rows))
    while any(t <= mark for t in store.timers):
        fire()
    return out, store, mark


def brute(orders, interval, mark):
    deadlines = [c + interval for _, c, _ in orders]
    out = []
    for i, c, reviewed in orders:
        at = min(t for t in deadlines if t >= c) if reviewed else c + interval
        if at <= mark:
            out.append((i, "already_reviewed" if reviewed else "auto_good", at))
    return sorted(out)


@pytest.mark.parametrize("run,batch", [(512, 40), (3, 7), (1, 1), (4, 1000)])
def test_order_timers_against_brute_force(monkeypatch, run, batch):
    monkeypatch.setattr(processors, "RUN_ORDERS", run)
    rng = random.Random(run)
    created = sorted(rng.randrange(1000) for _ in range(300))
    # a batch's rows may come in any order, later batches are newer
    created = [c for lo in range(0, 300, batch) for c in rng.sample(sorted(set(created[lo:lo + batch])), len(set(created[lo:lo + batch])))]
    orders = [(f"o{i}", c, rng.random() < 0.5) for i, c in enumerate(dict.fromkeys(created))]
    out, store, mark = drive(orders, 90, batch)
    assert sorted((r["order_id"], r["action"], r["action_ms"]) for r in out) == brute(orders, 90, mark)
    assert len(store.map) * run <= 300 + 300 * run


def test_order_timers_read_a_bounded_number_of_times():
    """100,000 orders of one user: what is read from the runs grows in proportion."""
    reads = {}
    for n in (25_000, 100_000):
        orders = [(f"o{i}", i, i % 2 == 0) for i in range(n)]
        out, store, mark = drive(orders, 20_000, 1000)
        assert len(out) == len(brute(orders[:1], 20_000, mark)) + sum(1 for _, c, r in orders[1:] if (max(c, 20_000) if r else c + 20_000) <= mark)
        reads[n] = store.read
    assert reads[100_000] < 8 * max(reads[25_000], 25_000)


# --- dashboard ---

SALES = "id long, ts timestamp, category string, price decimal(10,2), tag string"
START = dt.datetime(2024, 1, 1, 16)  # a day begins at 16:00


def sale(minutes, category, price):
    return (0, START + dt.timedelta(minutes=minutes), category, None if price is None else decimal.Decimal(price), "x")


def test_dashboard_chain_over_batches_and_restarts(spark, tmpdir_path):
    batches = [
        [sale(5, "a", "1.10"), sale(50, "b", "2.00"), sale(70, "a", "0.01")],
        [sale(130, "c", "9.00"), sale(320, "a", "1.00"), sale(330, None, "0.50")],  # silent hours between
        [sale(1445, "b", "3.00"), sale(1450, "d", None)],                             # the next day
        [(None, dt.datetime(9000, 1, 1), None, None, None)],
    ]
    for what in ("totals", "summary"):
        for i, rows in enumerate(batches):
            if what == "totals":
                spark.createDataFrame(rows, SALES).coalesce(1).write.parquet(f"{tmpdir_path}/in/{i}")
            s = spark.readStream.schema(SALES).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/in/*")
            out = dashboard_stream.day_totals(s, "ts", "category", "price", delay="10 minutes")
            if what == "summary":
                out = dashboard_stream.tick_summary(out, 2)
            q = (out.writeStream.format("parquet").option("path", f"{tmpdir_path}/{what}").option("checkpointLocation", f"{tmpdir_path}/ck-{what}")
                 .trigger(availableNow=True).start())  # a new start for each batch
            q.awaitTermination()

    def hour(ms):
        return (ms / 1000 - START.replace(tzinfo=dt.timezone.utc).timestamp()) / 3600
    got = {(hour(r["day"]), hour(r["tick"]), r["category"]): None if r["total"] is None else float(r["total"])
           for r in spark.read.parquet(f"{tmpdir_path}/totals").collect()}
    want = {(0, 1, "a"): 1.1, (0, 1, "b"): 2.0, (0, 2, "a"): 1.11, (0, 2, "b"): 2.0}
    for t in (3, 4, 5):
        want |= {(0, t, "a"): 1.11, (0, t, "b"): 2.0, (0, t, "c"): 9.0}
    want |= {(0, 6, "a"): 2.11, (0, 6, "b"): 2.0, (0, 6, "c"): 9.0, (0, 6, None): 0.5, (24, 25, "b"): 3.0, (24, 25, "d"): None}
    assert got == want
    summary = {(hour(r["tick"]), r["rank"]): (r["category"], r["total"]) for r in spark.read.parquet(f"{tmpdir_path}/summary").collect()}
    assert summary[6, 0] == (None, 13.61) and summary[6, 1] == ("c", 9.0) and summary[6, 2] == ("a", 2.11)
    assert summary[1, 0] == (None, 3.1) and summary[25, 0] == (None, 3.0) and (25, 2) not in summary and len(summary) == 6 * 3 + 2


# --- versions ---

@pytest.mark.parametrize("block", [None, 5])
def test_enrich_as_of_against_brute_force(spark, block):
    rng = random.Random(2)
    facts = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), "f") for i in range(200)]
    news = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(0, 40, 3)]), rng.randrange(100), "clash") for _ in range(40)]
    f = spark.createDataFrame(facts, "id long, k string, t long, name string")
    v = spark.createDataFrame(news, "k string, since long, value long, name string")
    blocks = scan.plan_blocks(f.where("t IS NOT NULL"), "t", rows=block) if block else None

    def newest(k, t, keyed=True):
        fit = [(s, x) for key, s, x, _ in news if s is not None and t is not None and s <= t and (key == k and k is not None or not keyed)]
        return max(fit, default=None)
    for how in ("inner", "left"):
        got = versions.enrich_as_of(f, v, ["k"], "t", "since", {"since": "since", "value": "value"}, how, blocks)
        want = [(i, k, t, n, *(newest(k, t) or (None, None))) for i, k, t, n in facts if how == "left" or newest(k, t)]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    whole = versions.enrich_as_of(f, v.drop("k"), [], "t", "since", {"value": "value"}, block_size=blocks)
    assert {(r["id"], r["value"]) for r in whole.collect()} == {(i, newest(None, t, False)[1]) for i, _, t, _ in facts if newest(None, t, False)}
    assert versions.enrich_as_of(f, v.limit(0), ["k"], "t", "since", {"value": "value"}).count() == 0


# --- hot keys ---

def test_hot_key_spreads_over_tasks(spark, tmpdir_path):
    """A third of the rows have one key: no task sees more than twice the median, and every result is right."""
    rng = random.Random(4)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(400)}", rng.choice([None, 1, 2, 5])) for i in range(12_000)]
    for b in range(3):
        spark.createDataFrame(rows[b * 4000:(b + 1) * 4000], "id long, k string, v long").repartition(3).write.parquet(f"{tmpdir_path}/in/{b}")
    s = spark.readStream.schema("id long, k string, v long").option("maxFilesPerTrigger", 3).parquet(f"{tmpdir_path}/in/*")

    def run(df, name):
        from pyspark.sql import functions as F
        tagged = df.withColumn("task", F.spark_partition_id())
        q = (tagged.writeStream.format("parquet").option("path", f"{tmpdir_path}/{name}").option("checkpointLocation", f"{tmpdir_path}/{name}-ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.parquet(f"{tmpdir_path}/{name}").collect()
    out = run(processors.running_stream(s, "k", "id", "v", "sum", block=64), "sum")
    now, want = {}, {}
    for i, k, v in rows:
        now[k] = processors._merge("sum", now.get(k), v)
        want[i] = now[k]
    assert {r["id"]: r["result"] for r in out} == want
    tasks = sorted(sum(r["task"] == t for r in out) for t in {r["task"] for r in out})
    assert len(tasks) >= 4 and tasks[-1] <= 2 * tasks[len(tasks) // 2]
    out = run(processors.count_window_stream(s, "k", "id", "v", 7, 3, block=64), "slide")
    seen, want = {}, set()
    for _, k, v in rows:
        seen.setdefault(k, []).append(v)
        if len(seen[k]) % 3 == 0:
            known = [x for x in seen[k][-7:] if x is not None]
            want.add((k, len(seen[k]), sum(known) if known else None))
    assert {(r["k"], r["fire_at"], r["value_sum"]) for r in out} == want
