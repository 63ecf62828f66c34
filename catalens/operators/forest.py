"""Random forests on the log target for all folds at once, each tree on a whole bootstrap sample.

Rows are drawn into bags by a hash of their id, so a bag depends on the data alone. Rows travel once and are packed;
a task reads the packs of one fold, grows ten trees on them (``trees``: nodes too large for memory are cut from columns on
disk) and says what its trees make of every row of the fold, drawn or not. So no tree leaves its task, and nothing passes
the driver but the settings of a fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.features import base_features
from catalens.operators.linear import FILLS, fold_medians
from catalens.operators.trees import teller, tree_maker
from catalens.staging import stage

# Forest settings.
TREES, MIN_LEAF = 300, 3
#: Bags grown in one task; rows dealt to one task, which small tables have fewer of, but up to that many tasks; rows in a pack.
TREES_A_TASK, ROWS_A_TASK, SMALL_TASKS, ROWS_A_PACK = 10, 32_768, 32, 4_096
#: Drawn rows of a node that is grown in memory; rows read at a time from a larger one.
HELD_ROWS, ROWS_A_PIECE = 100_000, 1_000_000

_FOREST = "validation_year int, tree int, feature array<int>, threshold array<double>, left array<int>, value array<double>"
_PACK = "_part int, _pack int, validation_year int, _rows binary, _columns binary, _draws array<binary>"
_TOLD = "_part int, _pack int, validation_year int, _block int, _grown int, _total binary"


def _features() -> Column:
    """Regressors as one array of floats, whose precision hides rounding; gaps take the fold's medians, a category is its mean log target (``_level``).

    Splits on that mean part the categories in its order, which is where the best split of a categorical
    feature lies; so any number of categories is one column.
    """
    columns = base_features()
    filled = [F.coalesce(c, F.col(dict(zip(columns, FILLS)).get(n))) if n in list(columns)[:4] else c for n, c in columns.items()]
    spend = F.coalesce(columns["log_budget"], F.lit(0.0))
    values = F.array(*filled, F.col("_level"), spend * F.col("_level"))
    return F.transform(values, lambda x: F.coalesce(x, F.lit(0.0)).cast("float"))


def fold_context(rows: DataFrame, folds: list[int], bag_rows: int | None = None) -> DataFrame:
    """Per fold and category: training rows, mean log target, median fills, share of rows a bag holds, rows to predict.

    The share is 1, a whole bootstrap sample, unless a caller asks for bags of about ``bag_rows`` draws.
    """
    met = F.filter(F.array(*[F.lit(int(f)) for f in folds]), lambda f: f >= F.col("year"))
    yearly = rows.groupBy("year", "primary_genre").agg(F.count("*").alias("n"), F.sum(F.log1p("revenue")).alias("s"))
    of_fold = yearly.withColumn("validation_year", F.explode(met))
    before = F.col("year") < F.col("validation_year")
    levels = of_fold.groupBy("validation_year", "primary_genre").agg(
        F.sum(F.when(before, F.col("n"))).alias("train_samples"),
        (F.sum(F.when(before, F.col("s"))) / F.sum(F.when(before, F.col("n")))).alias("_level"),
    )
    sizes = of_fold.groupBy("validation_year").agg(
        (F.least(F.lit(1.0), bag_rows / F.sum(F.when(before, F.col("n")))) if bag_rows else F.lit(1.0)).alias("_share"),
        F.sum("n").alias("_rows"),
    )
    fills = fold_medians(rows.filter(F.col("year") < max(folds)), folds)
    known = levels.filter("train_samples > 0").join(sizes, "validation_year").join(fills, "validation_year", "left")
    return stage(known.fillna(0.0, list(FILLS)))  # a row per fold and category: its size is known when it is joined


def _keyed(rows: DataFrame) -> DataFrame:
    own = F.xxhash64(*[F.col(c) for c in rows.columns])
    key = F.coalesce(F.col("id").cast("string"), own.cast("string")) if "id" in rows.columns else own.cast("string")
    return rows.withColumns({"_key": key, "_row": own})


def _met(rows: DataFrame, context: DataFrame) -> DataFrame:
    """Rows once per fold that trains on them or is validated by them, with features, a key and its hash."""
    right = context.withColumnRenamed("primary_genre", "_genre")
    met = _keyed(rows).join(right, (F.col("primary_genre") == F.col("_genre")) & (F.col("year") <= F.col("validation_year")))
    return met.withColumn("_features", _features()).drop("_genre", "_level", *FILLS)


def _number(number: Column) -> Column:
    """The first twelve hex digits of a digest of row, fold and ``number``, as a whole number."""
    text = F.concat_ws("|", F.col("_key"), F.col("validation_year").cast("string"), number.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def draw_bags(met: DataFrame, trees: int) -> DataFrame:
    """(validation_year, block, trees, features, label): training rows with the trees whose bags they are drawn into.

    A row has ``trees * share`` draws, a fraction by chance, and each falls on any tree: the counts in
    a bag are those of a bootstrap sample of that share. A row travels once per task that needs it.
    """
    expected = F.col("_share") * trees
    extra = _number(F.lit(0)) / float(16**12) < expected - F.floor(expected)
    drawn = met.filter(F.col("year") < F.col("validation_year")).withColumn("_draws", (F.floor(expected) + extra.cast("int")).cast("int"))
    chosen = drawn.filter("_draws > 0").withColumn(
        "_trees", F.transform(F.sequence(F.lit(1), F.col("_draws")), lambda i: F.pmod(_number(i), F.lit(trees)).cast("int"))
    )
    blocks = F.array_distinct(F.transform("_trees", lambda t: F.floor(t / TREES_A_TASK).cast("int")))
    return chosen.withColumn("_block", F.explode(blocks)).select(
        "validation_year", "_block", "_key", "_row", "_features", F.log1p("revenue").alias("_label"),
        F.filter("_trees", lambda t: F.floor(t / TREES_A_TASK) == F.col("_block")).alias("_trees"),
    )


def grow(bags: DataFrame, min_leaf: int = MIN_LEAF, max_depth: int | None = None) -> DataFrame:
    """The forest as a table, for bags that a task can hold: a row per fold and tree: feature, threshold (``<=`` goes to ``left``, else to the node after it), value per node.

    A leaf points to itself. Splits lower the squared error most; of equal ones (up to rounding) the first feature and the
    smallest threshold are taken. A leaf holds at least ``min_leaf`` different rows.
    """
    return bags.groupBy("validation_year", "_block").applyInArrow(_grower(min_leaf, max_depth), _FOREST)


def _grower(min_leaf: int, max_depth: int | None):
    tree_of = tree_maker(min_leaf, max_depth)

    def grow_block(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by([("_key", "ascending"), ("_row", "ascending")])  # sums run in one order whatever arrives first
        x = table["_features"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = x.reshape(table.num_rows, -1).T + np.float32(0)  # no negative zeros
        y = table["_label"].to_numpy()
        lists = table["_trees"].combine_chunks()
        drawn = lists.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        grown = []
        for tree in np.unique(drawn):
            weights = np.bincount(row[drawn == tree], minlength=table.num_rows)
            held = np.flatnonzero(weights)
            grown.append((int(tree), *tree_of(np.ascontiguousarray(x[:, held]), y[held], weights[held].astype(float))))
        year = table["validation_year"][0].as_py()
        trees, features, thresholds, lefts, values = zip(*grown)
        return pa.table(
            {
                "validation_year": pa.array([year] * len(trees), pa.int32()), "tree": pa.array(trees, pa.int32()),
                "feature": pa.array(features, pa.list_(pa.int32())), "threshold": pa.array(thresholds, pa.list_(pa.float64())),
                "left": pa.array(lefts, pa.list_(pa.int32())), "value": pa.array(values, pa.list_(pa.float64())),
            }
        )

    return grow_block


def _packer(columns: list[str], settings: dict[int, tuple], trees: int, folds_of: str = "_folds"):
    """Rows of one part in an order of their own, as packs: the rows once, and per fold their columns and draws.

    The draws are those of ``draw_bags``. Columns and draws are laid out one after the other, a fold's rows in a line.
    """
    size, a_task, fills = ROWS_A_PACK, TREES_A_TASK, len(FILLS)

    def drawn(keys, fold, share):
        """Times each row is drawn into each tree: a line per tree."""
        import hashlib

        import numpy as np

        expected = share * trees
        whole = int(expected)
        numbers = [str(i).encode() for i in range(1, whole + 2)]
        digests, times = [], np.full(len(keys), whole)
        for i, key in enumerate(keys):
            begun = hashlib.md5(f"{key}|{fold}|".encode())
            if expected > whole:
                chance = begun.copy()
                chance.update(b"0")
                times[i] += int.from_bytes(chance.digest()[:6], "big") / float(16**12) < expected - whole
            for number in numbers[: times[i]]:
                one = begun.copy()
                one.update(number)
                digests.append(one.digest())
        raw = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 16)[:, :6].astype(np.int64)
        tree = raw @ (256 ** np.arange(5, -1, -1, dtype=np.int64)) % trees
        row = np.repeat(np.arange(len(keys)), times)
        return np.bincount(tree * len(keys) + row, minlength=trees * len(keys)).reshape(trees, -1).astype(np.uint8)

    def pack(table):
        import zlib

        import numpy as np
        import pyarrow as pa

        table = table.sort_by([("_key", "ascending"), ("_row", "ascending")])  # sums run in one order whatever arrives first
        part, out = table["_part"][0].as_py(), []
        for number, lo in enumerate(range(0, table.num_rows, size)):
            rows = table.slice(lo, size)
            sink = pa.BufferOutputStream()
            kept = rows.select([*columns, folds_of])
            with pa.ipc.new_stream(sink, kept.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
                writer.write_table(kept)
            out.append((part, number, None, sink.getvalue().to_pybytes(), None, None))
            met = rows[folds_of].combine_chunks()
            of = np.repeat(np.arange(rows.num_rows), met.value_lengths().to_numpy(zero_copy_only=False))
            fold, level = (met.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("validation_year", "_level"))
            base = rows["_base"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            spend, label, year = (rows[c].to_numpy() for c in ("_spend", "_label", "year"))
            keys = np.array(rows["_key"].to_pylist(), dtype=object)
            for f in np.unique(fold).tolist():
                share, *middle = settings[f]
                chosen = np.flatnonzero(fold == f)
                row = of[chosen]
                x = np.column_stack([base[row], level[chosen].astype(np.float32), (spend[row] * level[chosen]).astype(np.float32)])
                for c in range(fills):
                    x[np.isnan(x[:, c]), c] = middle[c]
                times = np.zeros((trees, len(row)), dtype=np.uint8)
                trains = np.flatnonzero(year[row] < f)
                times[:, trains] = drawn(keys[row[trains]], f, share)
                held = np.ascontiguousarray(x.T + np.float32(0)).tobytes() + label[row].tobytes()  # no negative zeros
                blocks = [zlib.compress(times[t : t + a_task].tobytes(), 1) for t in range(0, trees, a_task)]
                out.append((part, number, f, None, zlib.compress(held, 1), blocks))
        names = ("_part", "_pack", "validation_year", "_rows", "_columns", "_draws")
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()))
        return pa.table({n: pa.array(v, k) for n, v, k in zip(names, zip(*out), kinds)})

    return pack


def _sayer(min_leaf: int, max_depth: int | None, width: int):
    """The packs of a fold with the draws of one block of trees: what these trees make of each row, summed up.

    The columns are written to files as they arrive and read from there, so a fold may have any number of rows.
    """
    tell = teller(min_leaf, max_depth, HELD_ROWS, ROWS_A_PIECE)

    def say(batches):
        import tempfile
        import zlib

        import numpy as np
        import pyarrow as pa

        def mapped(file, kind, n):
            file.flush()
            return np.asarray(np.memmap(file, dtype=kind, mode="r+", shape=(n,)))

        def made(kind, n):
            with tempfile.TemporaryFile() as file:  # its space is freed with the array
                file.truncate(n * np.dtype(kind).itemsize)
                return mapped(file, kind, n)

        files, packs, label = [tempfile.TemporaryFile() for _ in range(width + 1)], [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                held, draws = zlib.decompress(row["_columns"]), zlib.decompress(row["_drawn"])
                n = len(held) // (4 * width + 8)
                for c in range(width):
                    files[c].write(held[4 * n * c : 4 * n * (c + 1)])
                files[width].write(held[4 * n * width :])
                while len(files) < width + 1 + len(draws) // n:
                    files.append(tempfile.TemporaryFile())
                for t in range(len(draws) // n):
                    files[width + 1 + t].write(draws[n * t : n * (t + 1)])
                packs.append((row["_part"], row["_pack"], n))
                label = {c: row[c] for c in ("validation_year", "_block")}
        if not packs:
            return
        n = sum(k for _, _, k in packs)
        x, y = [mapped(f, np.float32, n) for f in files[:width]], mapped(files[width], np.float64, n)
        total = made(np.float64, n)
        grown = tell(x, y, [mapped(f, np.uint8, n) for f in files[width + 1 :]], total, made)
        ends = np.cumsum([k for _, _, k in packs])
        for lo in range(0, len(packs), 256):
            some = range(lo, min(lo + 256, len(packs)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([packs[i][0] for i in some], pa.int32()), pa.array([packs[i][1] for i in some], pa.int32()),
                    pa.array([label["validation_year"]] * len(some), pa.int32()), pa.array([label["_block"]] * len(some), pa.int32()),
                    pa.array([grown] * len(some), pa.int32()),
                    pa.array([total[ends[i] - packs[i][2] : ends[i]].tobytes() for i in some], pa.binary()),
                ],
                names=["_part", "_pack", "validation_year", "_block", "_grown", "_total"],
            )
        for f in files:
            f.close()

    return say


def _unpacker(columns: list[str], folds_of: str = "_folds"):
    """Rows of one part with the mean over the trees of each of their folds; null for a fold without trees."""

    def unpack(packed, told):
        import numpy as np
        import pyarrow as pa

        told = told.sort_by([("_pack", "ascending"), ("validation_year", "ascending"), ("_block", "ascending")])
        of_pack, of_fold = told["_pack"].to_numpy(), told["validation_year"].to_numpy()
        out = []
        for i in range(packed.num_rows):
            rows = pa.ipc.open_stream(packed["_rows"][i].as_buffer()).read_all()
            met = rows[folds_of].combine_chunks()
            year, samples = (met.flatten().field(c) for c in ("validation_year", "train_samples"))
            lengths, fold = met.value_lengths().to_numpy(zero_copy_only=False), year.to_numpy()
            mean = np.full(len(fold), np.nan)
            own = np.flatnonzero(of_pack == packed["_pack"][i].as_py())
            for f in np.unique(fold):
                lines = own[of_fold[own] == f].tolist()
                grown = sum(told["_grown"][j].as_py() for j in lines)
                if grown:
                    mean[fold == f] = sum(np.frombuffer(told["_total"][j].as_buffer()) for j in lines) / grown
            scores = pa.StructArray.from_arrays([year, samples, pa.array(mean, pa.float64(), mask=np.isnan(mean))], ["validation_year", "train_samples", "_log"])
            offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
            out.append(rows.select(columns).append_column("_scores", pa.ListArray.from_arrays(pa.array(offsets), scores)))
        return pa.concat_tables(out)

    return unpack


def _with_folds(rows: DataFrame, context: DataFrame) -> DataFrame:
    """Rows once, with the folds that train on them or are validated by them (``_folds``) and what ``_features`` needs of them."""
    seen = context.groupBy(F.col("primary_genre").alias("_genre")).agg(
        F.array_sort(F.collect_list(F.struct("validation_year", "train_samples", "_level"))).alias("_folds")
    )  # an entry per fold
    met = rows.join(seen, F.col("primary_genre") == F.col("_genre")).drop("_genre")
    met = met.withColumn("_folds", F.filter("_folds", lambda f: f["validation_year"] >= F.col("year"))).filter(F.size("_folds") > 0)
    columns = base_features()
    gaps = [F.coalesce(c, F.lit(float("nan") if i < len(FILLS) else 0.0)).cast("float") for i, c in enumerate(columns.values())]
    return met.withColumns({"_base": F.array(*gaps), "_spend": F.coalesce(columns["log_budget"], F.lit(0.0))})


def forest_predictions(
    rows: DataFrame, folds: list[int], trees: int = TREES, max_depth: int | None = None, min_leaf: int = MIN_LEAF, bag_rows: int | None = None
) -> DataFrame:
    """Grow a forest per fold on the rows before it and predict the rows up to and including it.

    Adds validation_year, train_samples (of the category) and the uncalibrated prediction; rows of categories
    without history in a fold drop out. The predictions are staged, a row with those of all its folds.
    """
    context = fold_context(rows, folds, bag_rows)
    known = rows.filter(F.col("year") <= max(folds))
    carried = list(rows.columns)
    settings = context.groupBy("validation_year").agg(F.first("_share"), F.max("_rows"), *[F.first(c) for c in FILLS])
    settings = {r[0]: tuple(r[1:]) for r in settings.collect()}  # a row per fold
    size = max((s[1] for s in settings.values()), default=0)
    parts = max(1, -(-size // ROWS_A_TASK), min(SMALL_TASKS, -(-size // 4_096)))
    blocks, years = -(-trees // TREES_A_TASK), sorted(settings, reverse=True)
    # rows travel to their part, a task each, and leave it packed
    whole = F.xxhash64(*[F.col(c) for c in carried])
    dealt = _with_folds(_keyed(known), context).withColumns({"_label": F.log1p("revenue"), "_part": F.pmod(whole, F.lit(parts)).cast("int")})
    of_fold = {f: (share, *fills) for f, (share, _, *fills) in settings.items()}
    packs = stage(dealt.repartition(parts, "_part").groupBy("_part").applyInArrow(_packer(carried, of_fold, trees), _PACK))
    # a task per fold and block of trees, the longest folds first
    block = F.posexplode("_draws").alias("_block", "_drawn")
    turn = F.array_position(F.array(*[F.lit(y) for y in years]), F.col("validation_year")) - 1 if years else F.lit(0)
    asked = packs.filter("validation_year is not null").select("_part", "_pack", "validation_year", "_columns", block)
    asked = asked.withColumn("_task", (turn * blocks + F.col("_block")).cast("int"))
    asked = asked.repartitionById(max(1, blocks * len(years)), "_task").sortWithinPartitions("_part", "_pack")
    told = asked.mapInArrow(_sayer(min_leaf, max_depth, len(base_features()) + 2), _TOLD)
    schema = ", ".join(f"`{c}` {dealt.schema[c].dataType.simpleString()}" for c in carried)
    schema += ", _scores array<struct<validation_year: int, train_samples: bigint, _log: double>>"
    rest = packs.filter("validation_year is null").select("_part", "_pack", "_rows")
    scored = stage(rest.groupBy("_part").cogroup(told.groupBy("_part")).applyInArrow(_unpacker(carried), schema))
    out = scored.select(*carried, F.inline("_scores")).filter("_log is not null")
    return out.withColumn("base_prediction", F.greatest(F.expm1("_log"), F.lit(0.0))).drop("_log")
