"""Problem 2: new batches against everything accepted so far.

``Ledger`` keeps, in a folder all executors reach, an inverted index of rare-run prefixes and the
accepted run sets and address keys. A batch is probed against them and its accepted rows are
appended, so no accepted text is read again, and run sets only in the ranges of ids that hold
candidates. Postings and keys are bucketed, so a probe shuffles the batch and never the history. A
ledger can be opened again in another session; what was not committed is not seen.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from khabarloom.llm import runjoin
from khabarloom.llm.neardup import RUNS_SQL
from khabarloom.runtime import cut, shared_dir

T = TypeVar("T")
#: Bits in which the fingerprints of two near-duplicates may differ.
DISTANCE = 8


#: Bytes of history per bucket of the index, the fewest buckets, and bytes of run sets per range of ids.
BUCKET_BYTES, LEAST_BUCKETS, RANGE_BYTES = 64 << 20, 8, 32 << 20
#: Ranges of ids that are looked up by their own bounds; more are read whole.
_BOUNDS = 64
#: Stored bytes of a batch (run sets, or keys) and of its candidates up to which all but its meeting with the
#: history is done in one task: many small shuffles cost more than the work, and each of them driver memory.
ONE_TASK_BYTES, FEW_BYTES = 32 << 20, 1 << 20
#: Stored bytes of a batch per bucket up to which its probes are hashed there, so that the history's are not sorted.
HASHED_BYTES = 8 << 20
#: Columns in which texts of one class agree: run set and fingerprint.
_CLASS = ["hi", "lo", "simhash"]
_SETS = "id bigint, simhash bigint, hi bigint, lo bigint, n int, runs array<bigint>, batch int, span bigint"
_TABLES = {"postings": ("run", "id BIGINT, simhash BIGINT, n INT, pos INT, run BIGINT"), "urls": ("url_hash", "url_hash STRING")}


def _close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def _bytes(stored: DataFrame) -> int:
    """Bytes of the files that ``stored`` is read from."""
    return stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The decisions on a small batch: its run sets (kind 0), what it met (1), run sets of the history (2), then its rows by ``order`` (3).

    An accepted id leaves its addresses (strings) and classes (numbers) behind; ids of one order do
    not see each other. Accepted ids carry their run set, ``first`` if no smaller one of its class does.
    """
    sets, keys, classes = {}, {}, defaultdict(set)  # run set and class key by id, least id and ids by class key
    least, met, near, known, hit = {}, defaultdict(list), defaultdict(set), set(), set()
    held, waiting, last, ids, told = set(), [], None, [], None

    def close(a: int, b: int, runs: np.ndarray, old: bool) -> None:
        mine = sets[a][1]
        if 3 * len(np.intersect1d(mine, runs, assume_unique=True)) >= len(mine) + len(runs):
            if old:
                hit.add(keys[a])
            else:
                near[keys[a]].add(keys[b])
                near[keys[b]].add(keys[a])

    for batch in batches:
        kind = batch.column("kind").to_numpy()
        for k, part in ((k, batch.filter(pa.array(kind == k))) for k in np.unique(kind)):
            c = {name: part.column(name) for name in part.schema.names}
            if k == 3:
                ids += zip(c["id"].to_pylist(), c["order"].to_pylist(), c["url_hash"].to_pylist())
                continue
            if k == 1:
                for a, b, old, url in zip(*(c[x].to_pylist() for x in ("id", "other", "old", "url_hash"))):
                    if url is not None:
                        known.add(url)
                    elif old:
                        met[b].append(a)
                    else:
                        close(a, b, sets[b][1], False)
                continue
            ends, runs = c["runs"].offsets.to_numpy(), c["runs"].values.to_numpy()
            for i, (name, *key) in enumerate(zip(*(c[x].to_pylist() for x in ("id", *_CLASS)))):
                own = runs[ends[i] : ends[i + 1]]
                if k == 2:
                    for a in met.pop(name, ()):
                        close(a, name, own, True)
                else:
                    keys[name] = tuple(key)
                    sets[name] = keys[name], own.copy()
                    classes[name].add(keys[name])
                    least[keys[name]] = min(name, least.get(keys[name], name))

    by_id: dict[int, tuple] = {}
    for name, order, url in ids:  # rows of one id are one row
        by_id.setdefault(name, (order, set()))[1].update(() if url is None else (url,))
    accepted = {}
    for name, (order, urls) in by_id.items():
        if order != last:
            held.update(*waiting)
            waiting, last = [], order
        around = urls | classes[name]
        for key in classes[name]:
            around = around | near[key]
        accepted[name] = held.isdisjoint(around) and known.isdisjoint(urls) and hit.isdisjoint(classes[name])
        if accepted[name]:
            waiting.append(urls | classes[name])
    first: dict[tuple, int] = {}
    for name, free in accepted.items():
        if free and name in keys:
            first[keys[name]] = min(name, first.get(keys[name], name))
    order = list(by_id)
    for at in range(0, len(order), 5_000):
        told = order[at : at + 5_000]
        kept = [sets.get(x) if accepted[x] else None for x in told]
        fields = {
            "id": pa.array(told, pa.int64()),
            "accepted": pa.array([accepted[x] for x in told], pa.bool_()),
            "first": pa.array([k is not None and first[k[0]] == x for x, k in zip(told, kept)], pa.bool_()),
            "urls": pa.array([sorted(by_id[x][1]) if accepted[x] else [] for x in told], pa.list_(pa.string())),
            **{c: pa.array([k and k[0][i] for k in kept], pa.int64()) for i, c in enumerate(_CLASS)},
            "n": pa.array([None if k is None else len(k[1]) for k in kept], pa.int32()),
            "runs": pa.array([None if k is None else k[1] for k in kept], pa.list_(pa.int64())),
        }
        yield pa.RecordBatch.from_arrays(list(fields.values()), names=list(fields))


_WALKED = "id bigint, accepted boolean, first boolean, urls array<string>, hi bigint, lo bigint, simhash bigint, n int, runs array<bigint>"


def _overlapping(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows of ``pairs`` (a, b, old) whose run sets overlap by 0.5: a is in ``left``, b in ``right``."""
    both = pairs.join(left.select(F.col("id").alias("a"), F.col("runs").alias("ra")), "a").join(right.select(F.col("id").alias("b"), F.col("runs").alias("rb")), "b")
    shared = F.size(F.array_intersect("ra", "rb"))
    return both.filter(3 * shared >= F.size("ra") + F.size("rb")).select("a", "b", "old").distinct()


class Ledger:
    """What was accepted so far, as three tables that only grow.

    * postings, bucketed by run: the probed runs of one text per (run set, fingerprint);
    * run sets, by ranges of ``id`` and sorted in them: a verification reads the ranges it has
      candidates in, and of these the row groups between its smallest and largest;
    * address keys, bucketed by key.

    Rows carry the number of their append and count once it is committed, which is its last step: an
    append that broke off is not seen, and the next one writes over it. The order of runs is that of
    the first history; it decides what a probe costs, not what it finds. One writer at a time.

    ``history`` and batches have ``id`` (a bigint, unique over both, rising with arrival), ``order``
    (comparable, ascending in time), ``url_hash``, ``simhash`` and ``text``. A NULL ``url_hash``
    matches nothing, a NULL or 0 ``simhash`` and a text without tokens are near nothing. Rows of one
    id are one row. Further columns are ignored.
    """

    def __init__(self, spark: SparkSession, path: str, runs: runjoin.RunOrder | None = None) -> None:
        """Open the ledger in the folder ``path``; ``runs``: its order of runs, if it is at hand."""
        self.spark, self.path = spark, path
        told = spark.read.parquet(f"{path}/about").first()
        self.buckets, self.span = told.buckets, told.span
        kept = spark.read.parquet(f"{path}/order")
        self.runs = runs or runjoin.RunOrder(*((np.frombuffer(bytes(kept.first()[0]), np.uint8), None) if told.counters else (None, kept)))
        self.name = "ledger_" + hashlib.md5(path.encode()).hexdigest()[:16]
        for table, (column, columns) in _TABLES.items():
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name}_{table} ({columns}, batch INT) USING parquet PARTITIONED BY (batch) CLUSTERED BY ({column}) SORTED BY ({column}) INTO {self.buckets} BUCKETS LOCATION '{path}/{table}'")
            fs, at = self._folder(table)
            fs.mkdirs(at)
            spark.sql(f"ALTER TABLE {self.name}_{table} RECOVER PARTITIONS")  # a catalog that has not seen them
        self.appended = self._committed()

    @classmethod
    def create(cls, history: DataFrame, path: str | None = None, buckets: int | None = None, span: int | None = None) -> Ledger:
        """A new ledger of ``history``, in ``path`` or a folder of its own; sizes follow the history's bytes and ids."""
        spark = history.sparkSession
        path = path or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
        told = history.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
        size = told.bytes or 0
        buckets = buckets or max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
        span = span or 1 << max(10, (RANGE_BYTES * (told.n or 1) // max(1, size)).bit_length() - 1)
        order = runjoin.run_order(history, "text")
        runjoin.stored_order(spark, order).write.parquet(f"{path}/order")
        about = F.lit(buckets).cast("int").alias("buckets"), F.lit(span).cast("long").alias("span"), F.lit(order.counters is not None).alias("counters")
        spark.range(1).select(*about).write.parquet(f"{path}/about")
        ledger = cls(spark, path, order)
        ledger._append(history, ledger._sets(history))
        return ledger

    def _committed(self) -> int:
        """The number of appends that were completed."""
        at = self._folder("commits")
        return sum(1 for _ in at[0].listStatus(at[1])) if at[0].exists(at[1]) else 0

    def _folder(self, name: str):  # noqa: ANN202
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _sets(self, rows: DataFrame) -> DataFrame:
        """Run sets of the rows whose fingerprint and text can have a near-duplicate."""
        usable = rows.filter(F.coalesce("simhash", F.lit(0)) != 0)
        return runjoin.ordered_sets(usable, "id", "text", self.runs, keep=["simhash"], whole=True)

    def _range(self) -> Column:
        return F.floor(F.col("id") / self.span)

    def _table(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{table}").filter(F.col("batch") < self.appended).drop("batch")

    def _grow(self, rows: DataFrame, table: str) -> None:
        column = _TABLES[table][0]
        placed = rows.repartition(self.buckets, column)
        placed = placed.distinct() if table == "urls" else placed
        out = placed.withColumn("batch", F.lit(self.appended)).write.mode("append").format("parquet")
        out = out.option("compression", "zstd").option("path", f"{self.path}/{table}").partitionBy("batch")
        out.bucketBy(self.buckets, column).sortBy(column).saveAsTable(f"{self.name}_{table}")

    def _append(self, rows: DataFrame, sets: DataFrame, firsts: DataFrame | None = None) -> None:
        """Add accepted rows and their run sets to the three tables, then commit; ``firsts``: one run set per class, if at hand."""
        for table in ("sets", *_TABLES):  # what an append of this number that broke off has left
            fs, at = self._folder(f"{table}/batch={self.appended}")
            fs.delete(at, True)
        at = f"{self.path}/sets/batch={self.appended}"
        placed = sets.withColumn("span", self._range()).sortWithinPartitions("span", "id")
        placed.write.option("compression", "zstd").option("parquet.block.size", str(4 << 20)).partitionBy("span").parquet(at)
        own = self.spark.read.schema(_SETS).option("basePath", f"{self.path}/sets").parquet(at)
        probed = runjoin.postings(runjoin.one_per_class(own, "id", _CLASS, whole=self.appended == 0) if firsts is None else firsts, "id", "simhash")
        self._both(
            lambda: self._grow(probed.select("id", "simhash", "n", "pos", "run"), "postings"),
            lambda: self._grow(rows.filter("url_hash is not null").select("url_hash"), "urls"),
        )
        fs, done = self._folder(f"commits/{self.appended}")
        fs.mkdirs(done)
        self.appended += 1

    @staticmethod
    def _both(*jobs: Callable[[], T]) -> list[T]:
        """What the jobs return; they run beside one another, as each is too small for a cluster by itself."""
        with ThreadPoolExecutor(len(jobs)) as pool:
            return [f.result() for f in [pool.submit(job) for job in jobs]]

    def _stored_sets(self, ids: DataFrame) -> DataFrame:
        """(id, runs) of accepted texts; only ranges of ``ids`` (column id), and there between the least and greatest, are read.

        The list of ranges is bounded by the history's length over ``span``.
        """
        ends = ids.groupBy(self._range().alias("s")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()
        return self._in_ranges([tuple(r) for r in ends]).join(ids, "id", "left_semi").select("id", "runs")

    def _in_ranges(self, ends: list[tuple[int, int, int]]) -> DataFrame:
        """Accepted run sets of the ranges (number, least id, greatest id)."""
        stored = self.spark.read.schema(_SETS).parquet(f"{self.path}/sets").filter((F.col("batch") < self.appended) & F.col("span").isin([s for s, _, _ in ends]))
        if 0 < len(ends) <= _BOUNDS:
            stored = stored.filter(reduce(Column.__or__, [F.col("id").between(lo, hi) for _, lo, hi in ends]))
        return stored

    def _by_bucket(self, rows: DataFrame, column: str, size: int) -> DataFrame:
        """``rows`` of a batch, stored in ``size`` bytes, as they meet a table of this ledger; hashed if they are few per bucket."""
        placed = rows.repartition(self.buckets, column)
        return placed.hint("shuffle_hash") if size <= self.buckets * HASHED_BYTES else placed

    def _met(self, probes: DataFrame, index: DataFrame) -> DataFrame:
        """(a, b, least): the probed runs that a text of ``probes`` has in common with one of ``index``, one by one."""
        p, q = probes.alias("p"), index.alias("q")
        np_, nq = F.col("p.n"), F.col("q.n")
        met = p.join(
            q,
            (F.col("p.run") == F.col("q.run"))
            & (F.col("p.id") != F.col("q.id"))
            & _close(F.col("p.simhash"), F.col("q.simhash"))
            & runjoin.probed(np_, F.col("p.pos"), nq, F.col("q.pos")),
        )
        return met.select(F.col("p.id").alias("a"), F.col("q.id").alias("b"), runjoin.least_met(np_, nq).alias("least"))

    def _candidates(self, sets: DataFrame, rows: DataFrame, size: int, keys: int) -> DataFrame:
        """(a, b, old, url_hash): texts of the batch and of the history (``old``) or the batch that may overlap by 0.5; and known addresses."""
        if max(size, keys) <= ONE_TASK_BYTES:
            classes = sets.coalesce(1).groupBy(*_CLASS).agg(F.min(F.struct("id", "n", "runs")).alias("first")).select("simhash", "first.*")
        else:
            classes = runjoin.one_per_class(sets, "id", _CLASS, whole=False)
        probes = self._by_bucket(runjoin.postings(classes, "id", "simhash"), "run", size)
        old, new = self._met(probes, self._table("postings")), self._met(probes, probes).filter("a < b")
        both = old.withColumn("old", F.lit(True)).unionByName(new.withColumn("old", F.lit(False)))
        pairs = both.groupBy("a", "b", "least", "old").agg(F.count(F.lit(1)).alias("met")).filter("met >= least").select("a", "b", "old")
        addresses = self._by_bucket(rows.filter("url_hash is not null").select("url_hash"), "url_hash", keys)
        return pairs.unionByName(self._table("urls").join(addresses, "url_hash", "left_semi"), allowMissingColumns=True)

    def decide(self, batch: DataFrame) -> DataFrame:
        """(id, accepted) for every row of ``batch``, taken one by one in ``order``.

        The batch may hold several batches, if ``order`` puts them one after another. Rows are
        rejected if an accepted row has their ``url_hash``, or has a fingerprint within 8 bits and
        an overlap of 0.5 or more.
        """
        return self._decide(batch)[0]

    def _decide(self, batch: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
        """The decisions on ``batch``, and the step that appends its accepted rows."""
        sets, rows = self._both(lambda: cut(self._sets(batch), "batch-sets"), lambda: cut(batch.select("id", "order", "url_hash"), "batch-keys"))
        size, keys = _bytes(sets), _bytes(rows)
        met = cut(self._candidates(sets, rows, size, keys), "batch-met")
        if max(size, keys) <= ONE_TASK_BYTES and _bytes(met) <= FEW_BYTES:
            walked = self._decide_few(rows, sets, met)
            taken = walked.filter("accepted")
            own = taken.filter("runs is not null").select("id", "simhash", "hi", "lo", "n", "runs", "first")
            return walked.select("id", "accepted"), lambda: self._append(taken.select(F.explode("urls").alias("url_hash")), own.drop("first"), own.filter("first"))
        verdict = self._decide_many(rows, sets, met)
        taken = verdict.filter("accepted").select("id")
        return verdict, lambda: self._append(rows.join(taken, "id", "left_semi"), sets.join(taken, "id", "left_semi"))

    def _decide_few(self, rows: DataFrame, sets: DataFrame, met: DataFrame) -> DataFrame:
        """As ``_decide_many``, in one task; with the run sets and addresses of accepted ids."""
        ids = sorted({r.b for r in met.filter("old").select("b").collect()})  # as many as FEW_BYTES hold
        found = met.filter(F.lit(False)).select(F.col("b").alias("id"), F.lit(None).cast("array<bigint>").alias("runs"))
        if ids:
            wanted = self.spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int64())}))
            found = self._in_ranges([(s, min(x), max(x)) for s, x in self._by_range(ids).items()]).join(F.broadcast(wanted), "id", "left_semi").select("id", "runs").repartition(1)
        parts = [
            sets.drop("n").withColumn("kind", F.lit(0)),
            met.withColumnsRenamed({"a": "id", "b": "other"}).withColumn("kind", F.lit(1)),
            found.withColumn("kind", F.lit(2)),
            rows.withColumn("kind", F.lit(3)),
        ]
        both = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
        return cut(both.coalesce(1).sortWithinPartitions("kind", "order").mapInArrow(_walk, _WALKED), "batch-state")

    def _by_range(self, ids: list[int]) -> dict[int, list[int]]:
        out = defaultdict(list)
        for i in ids:
            out[i // self.span].append(i)
        return out

    def _decide_many(self, rows: DataFrame, sets: DataFrame, met: DataFrame) -> DataFrame:
        groups = sets.groupBy("hi", "lo", "simhash").agg(F.min("id").alias("cls"))
        member = sets.select("id", "hi", "lo", "simhash").distinct().join(groups, ["hi", "lo", "simhash"]).select("id", "cls")
        pairs, known = met.filter("url_hash is null").drop("url_hash"), met.filter("url_hash is not null").select("url_hash")
        seen = rows.join(known, "url_hash", "left_semi").select("id")
        own = sets.select("id", "runs")
        there = self._stored_sets(pairs.filter("old").select(F.col("b").alias("id")).distinct()).unionByName(own.join(pairs.filter("not old").select(F.col("b").alias("id")).distinct(), "id", "left_semi"))
        near = cut(_overlapping(pairs, own, there), "batch-near")

        like = member.join(near.filter("old").select(F.col("a").alias("cls")).distinct(), "cls", "left_semi").select("id")
        blocked = seen.unionByName(like).distinct().withColumn("blocked", F.lit(True))
        nodes = rows.join(member, "id", "left").join(blocked, "id", "left")
        nodes = nodes.withColumn("state", F.when(F.col("blocked"), 2).otherwise(0)).drop("blocked")
        return self._resolve(cut(nodes, "batch-nodes"), near.filter("not old").select("a", "b"))

    def _resolve(self, nodes: DataFrame, near: DataFrame) -> DataFrame:
        """Accept in order: rounds over the rows that still wait for an earlier one.

        Rows meet in groups (one address, or one text class), so a group of any size costs its
        number of rows, never its number of pairs. ``state``: 0 open, 1 accepted, 2 rejected.
        """
        url = F.concat(F.lit("u"), F.col("url_hash"))
        cls = F.concat(F.lit("c"), F.col("cls").cast("string"))
        in_group = nodes.select("id", F.explode(F.array_compact(F.array(url, cls))).alias("g"))
        both = near.select(F.concat(F.lit("c"), F.col("a").cast("string")).alias("g"), F.concat(F.lit("c"), F.col("b").cast("string")).alias("h"))
        beside = both.unionByName(both.select(F.col("h").alias("g"), F.col("g").alias("h"))).unionByName(in_group.select("g", F.col("g").alias("h")).distinct())
        beside = beside.select("g", "h")
        state, rounds = nodes.select("id", "order", "url_hash", "cls", "state"), 0
        while rounds == 0 or not state.filter("state = 0").isEmpty():
            rounds += 1
            if rounds == 2:  # most batches are settled in one round
                beside = cut(beside, "batch-beside")
            there = state.select("id", "order", "state", F.explode(F.array_compact(F.array(url, cls))).alias("g"))
            firsts = there.groupBy("g").agg(
                F.min(F.when(F.col("state") == 1, F.col("order"))).alias("acc"),
                F.min(F.when(F.col("state") == 0, F.col("order"))).alias("open"),
            )
            around = firsts.withColumnRenamed("g", "h").join(beside, "h").groupBy("g").agg(F.min("acc").alias("acc"), F.min("open").alias("open"))
            verdict = there.filter("state = 0").join(around, "g").groupBy("id").agg(
                F.bool_or(F.coalesce(F.col("acc") < F.col("order"), F.lit(False))).alias("reject"),
                F.bool_and(F.col("open") >= F.col("order")).alias("first"),
            )
            told = state.join(verdict, "id", "left")
            free = F.col("reject").isNull()  # a row in no group
            state = cut(
                told.withColumn("state", F.when(F.col("state") != 0, F.col("state")).when(free, 1).when(F.col("reject"), 2).when(F.col("first"), 1).otherwise(0)).drop("reject", "first"),
                "batch-state",
            )
        return state.select("id", (F.col("state") == 1).alias("accepted"))

    def add(self, batch: DataFrame) -> DataFrame:
        """Decide a batch, then append its accepted rows to the index; returns the decisions. Its texts are broken into runs once."""
        verdict, append = self._decide(batch)
        append()
        return verdict

    def remove(self) -> None:
        """Delete the ledger; decisions it has given stay."""
        for table in _TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{table}")
        fs, at = self._folder("about")
        fs.delete(at.getParent(), True)


def _rows(df: DataFrame, order: Column) -> DataFrame:
    return df.select(F.col("article_id").alias("id"), order.alias("order"), "url_hash", "simhash", runjoin.story_text().alias("text"))


def found(articles: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows that are not accepted, all of ``articles`` being accepted; batches are added one by one, in order."""
    ledger = Ledger.create(_rows(articles, F.col("article_id")))
    numbers = sorted((r[0] for r in incoming.select("batch_no").distinct().collect()), key=lambda n: (n is not None, n))
    refused = [_refused(ledger.add(_rows(incoming.filter(F.col("batch_no").eqNullSafe(F.lit(n))), F.col("article_id")))) for n in numbers]
    ledger.remove()
    return reduce(DataFrame.unionByName, refused) if refused else incoming.select("article_id").limit(0)


def _refused(verdict: DataFrame) -> DataFrame:
    return verdict.filter("not accepted").select(F.col("id").alias("article_id")).distinct()


_PAIRS_SQL = """
  SELECT i.article_id AS a, o.article_id AS b FROM incoming_articles i JOIN {0} o ON bit_count(xor(i.simhash, o.simhash)) <= 8
  JOIN sets_incoming_articles x ON x.article_id = i.article_id JOIN sets_{0} y ON y.article_id = o.article_id
  WHERE i.simhash <> 0 AND o.simhash <> 0 AND i.article_id <> o.article_id AND 3 * len(list_intersect(x.r, y.r)) >= len(x.r) + len(y.r) AND len(x.r) > 0"""

FOUND_SQL = f"""
WITH RECURSIVE {RUNS_SQL.format('articles')}, {RUNS_SQL.format('incoming_articles')},
old AS (SELECT DISTINCT a AS article_id FROM ({_PAIRS_SQL.format('articles')}) UNION SELECT article_id FROM incoming_articles WHERE url_hash IN (SELECT url_hash FROM articles)),
near AS ({_PAIRS_SQL.format('incoming_articles')} UNION SELECT a.article_id, b.article_id FROM incoming_articles a JOIN incoming_articles b ON a.url_hash = b.url_hash AND a.article_id <> b.article_id),
nears AS (SELECT a AS article_id, list(b) AS nears FROM near GROUP BY 1),
ordered AS MATERIALIZED (
  SELECT article_id, row_number() OVER (ORDER BY batch_no, article_id) AS rn, o.article_id IS NOT NULL AS old, coalesce(n.nears, []) AS nears
  FROM incoming_articles LEFT JOIN old o USING (article_id) LEFT JOIN nears n USING (article_id)
), walk AS (
  SELECT 0::BIGINT AS rn, NULL::BIGINT AS article_id, true AS taken, []::BIGINT[] AS held
  UNION ALL
  SELECT o.rn, o.article_id, NOT o.old AND NOT list_has_any(w.held, o.nears),
    CASE WHEN NOT o.old AND NOT list_has_any(w.held, o.nears) THEN list_append(w.held, o.article_id) ELSE w.held END
  FROM walk w JOIN ordered o ON o.rn = w.rn + 1
)
SELECT article_id FROM walk WHERE rn > 0 AND NOT taken
"""
