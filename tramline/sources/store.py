"""A partitioned store of positions: by day and by cell of a space-filling curve, written batch by batch.

A position's code interleaves the bits of its longitude and latitude, so near codes are near places; a cell is the first
bits of a code. A box is asked for by the ranges of cells that it meets, which prune partitions, and by its own bounds.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

#: Bits of a coordinate in a code, and of those in a cell (a third of a degree of longitude, half of that of latitude).
CODE_BITS, CELL_BITS = 16, 10
#: Ranges of cells that a query is put into.
RANGES_MOST = 64


def spread(x: Column) -> Column:
    """The bits of a number with a 0 before each: its binary digits read in base 4."""
    return F.conv(F.bin(x), 4, 10).cast("long")


def scaled(x: Column, low: float, span: float) -> Column:
    """0 to 2 ** CODE_BITS - 1 over the span; NULL outside it."""
    steps = 1 << CODE_BITS
    return F.when(x.between(low, low + span), F.least(F.floor((x - low) / span * steps), F.lit(steps - 1)).cast("long"))


def place_code(lat: Column, lon: Column) -> Column:
    """The code of a position; NULL where a coordinate is NULL or off the globe."""
    return F.shiftleft(spread(scaled(lat, -90.0, 180.0)), 1).bitwiseOR(spread(scaled(lon, -180.0, 360.0)))


def with_cells(rows: DataFrame, ts: str = "timestamp") -> DataFrame:
    """place, cell and day beside lat, lon and the time; cells of unknown places are -1."""
    rows = rows.withColumn("place", place_code(F.col("lat"), F.col("lon")))
    cell = F.coalesce(F.shiftright("place", 2 * (CODE_BITS - CELL_BITS)), F.lit(-1)).cast("int")
    return rows.withColumn("cell", cell).withColumn("day", F.col(ts).cast("date"))


def save(rows: DataFrame, path: str, batch_id: int, ts: str = "timestamp") -> None:
    """Writes a batch's rows; a batch that is written again replaces its own rows, and adds nothing.

    Rows are dealt by ranges of day and place, so a busy cell is spread over tasks, and files hold few cells, in order.
    """
    dealt = with_cells(rows, ts).repartitionByRange("day", "cell", "place").sortWithinPartitions("day", "cell", "place")
    dealt.write.mode("overwrite").partitionBy("day", "cell").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def save_stream(rows: DataFrame, path: str, ts: str = "timestamp") -> DataStreamWriter:
    """The same for each micro-batch; the caller sets checkpoint and trigger, and starts it."""
    return rows.writeStream.foreachBatch(lambda batch, batch_id: save(batch, path, batch_id, ts))


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a store, with batch, day and cell."""
    return spark.read.parquet(path)


def cell_ranges(south: float, west: float, north: float, east: float, most: int = RANGES_MOST) -> list[tuple[int, int]]:
    """First and last cell of runs that hold all cells that meet the box, in order; a quadrant inside it is one run.

    If there are more than `most` of them, those with the fewest cells between are joined, so some cells outside come too.
    """
    out: list[tuple[int, int]] = []

    def visit(cell: int, bits: int, lat: float, lon: float) -> None:
        height, width = 180 / (1 << bits), 360 / (1 << bits)
        if lat > north or lat + height < south or lon > east or lon + width < west:
            return
        inside = south <= lat and lat + height <= north and west <= lon and lon + width <= east
        if inside or bits == CELL_BITS:
            rest = 2 * (CELL_BITS - bits)
            first, last = cell << rest, (cell + 1 << rest) - 1
            if out and out[-1][1] == first - 1:
                out[-1] = (out[-1][0], last)
            else:
                out.append((first, last))
            return
        for quadrant in range(4):
            visit(cell << 2 | quadrant, bits + 1, lat + height / 2 * (quadrant >> 1), lon + width / 2 * (quadrant & 1))

    visit(0, 0, -90.0, -180.0)
    if len(out) > most:
        between = sorted(range(1, len(out)), key=lambda k: out[k][0] - out[k - 1][1])
        starts = [0, *sorted(between[len(out) - most :]), len(out)]
        out = [(out[a][0], out[b - 1][1]) for a, b in pairwise(starts)]
    return out


def any_of(conditions: list[Column]) -> Column:
    """Their disjunction, as a tree of little depth."""
    if len(conditions) < 2:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def in_box(rows: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """Rows with cells (see with_cells, stored) whose position is in the box, ends included.

    West may be greater than east: the box then crosses the date line.
    """
    spans = [(west, east)] if west <= east else [(west, 180.0), (-180.0, east)]
    ranges = [r for a, b in spans for r in cell_ranges(south, a, north, b)]
    near = any_of([F.col("cell").between(first, last) if first < last else F.col("cell") == first for first, last in ranges])
    return rows.filter(near & F.col("lat").between(south, north) & any_of([F.col("lon").between(a, b) for a, b in spans]))
