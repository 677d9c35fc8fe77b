"""Fuzzy line dedup by MinHash, in DataFrame operations only.

1. Equal lines collapse, with a map-side combine: one row a distinct line, named by its 64-bit hash.
2. Signature: a line's shingles are all runs of ``shingle`` characters. A component of the signature is the smallest shingle
   hash after XOR with a random constant, that is the hash nearest to a random point; two lines agree in it with the
   probability of their Jaccard similarity. Shingles are exploded and aggregated inside one generated loop.
3. Banding: ``bands`` bands of ``rows`` components; lines that agree in a band meet in its bucket. With 6 bands of 3, a pair
   of similarity 0.8 meets with probability 0.987, one of 0.9 with 0.9996.
4. Verification: exact Jaccard similarity of the shingle sets, always of a line with a leader, never of all lines with all.
   The leader of a bucket is its most frequent line. What differs from the leader is then dealt anew: two lines that are
   similar, but not both to their leader, share much of what sets them apart from it. So each line goes to buckets named
   by MinHashes of the shingles it has and the leader has not (and, after the first comparison, of those it lacks); buckets of more than one known component get a leader of their own, and so on until no bucket has two. A bucket shrinks with each round, and lines that differ from their leader in nothing common part at once: a large
   group of similar lines, or of variants of one template, costs a comparison a line and round.
5. Union-find: components by distributed star steps. The first line of a component, by document and place, stays.

Distinct lines lie in a table bucketed by their name, so comparing fetches texts without shuffling the table. Hot names
(a line in a third of all documents) and hot buckets are skewed keys of joins between plain exchanges, which Spark splits.

Defined results: lines without a word are not looked at, and stay. A null text has no lines. Lines shorter than a
shingle are equal or unlike. A null id ranks before all others. Rows that repeat an id are told apart by nothing:
of equal places the line counts once each, and all that stand at the first place stay. An empty table gives an empty
result. Other columns are ignored. Two different lines with one 64-bit hash would count as equal; among a billion
distinct lines that is a chance of 3 in 100.
"""

from __future__ import annotations

import random
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from modrisk.llm.components import components
from modrisk.llm.shared import WORD, freed_shuffles, numbered, renamed, whole_text, work_folder, written

SHINGLE = 10
BANDS = 6
ROWS = 3
THRESHOLD = 0.8
PLACES = 8  # shingles of one generated row
MARKS = 6  # names of what sets a line apart from its leader


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line_no, line, k) of the lines with a word; k names the line."""
    split = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(whole_text(text_col), "\n")).alias("line_no", "line"))
    return split.filter(F.regexp_like("line", F.lit(WORD))).withColumn("k", F.xxhash64("line"))


def _codes(line: Column) -> Column:
    """Four bytes a character, so that a shingle is a slice of bytes."""
    return F.encode(line, "UTF-32")


def _shingle(codes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.substr(codes, (at * F.lit(4) + F.lit(1)).cast("int"), F.lit(4 * size)))


def shingles(line: Column, size: int) -> Column:
    """The hashes of all runs of ``size`` characters of a line that has at least one. A line of single bytes is sliced; a lambda's
    variable keeps its bytes at hand, or else each slice would copy the line. For others the regular expression is several times
    faster than a slice for each place."""
    places = F.sequence(F.lit(1), F.length(line) - (size - 1))
    sliced = F.transform(F.array(line.cast("binary")), lambda b: F.transform(places, lambda i: F.xxhash64(F.substr(b, i, F.lit(size)))))[0]
    runs = F.regexp_extract_all(line, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
    found = F.transform(runs, lambda x: F.xxhash64(x))
    single = (F.length(line) == F.octet_length(line)) & (F.length(line) >= size)
    return F.when(single, sliced).otherwise(found)


def _points(n: int) -> list[int]:
    draw = random.Random(1)
    return [draw.getrandbits(64) - 2**63 for _ in range(n)]


def _band_keys(lines: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(sk, bands): an array of bucket names for each line.

    The codes pass through a generator, or else each shingle would encode its line anew. A generated row stands for several
    places: fewer look-ups of the line's aggregate. Places beyond the last repeat the last, which changes no minimum.
    """
    codes = lines.select("k", (F.length("line") - size).alias("last"), F.explode(F.array(_codes(F.col("line")))).alias("codes"))
    at = codes.select("k", "codes", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(PLACES))).alias("at"))
    hashes = at.select(
        "k", *[_shingle(F.col("codes"), F.least(F.col("at") + j, F.col("last")), size).alias(f"h{j}") for j in range(PLACES)]
    )
    lowest = [
        F.min(F.least(*[F.col(f"h{j}").bitwiseXOR(F.lit(p)) for j in range(PLACES)])).alias(f"s{i}")
        for i, p in enumerate(_points(bands * rows))
    ]
    signature = hashes.groupBy("k").agg(*lowest)
    keys = [F.xxhash64(F.lit(b), *[F.col(f"s{b * rows + i}") for i in range(rows)]) for b in range(bands)]
    return signature.select(F.col("k").alias("sk"), F.array(*keys).alias("bands"))


class _Lines:
    """The distinct lines, bucketed by name."""

    def __init__(self, lines: DataFrame, folder: str):
        spark = lines.sparkSession
        self.name = f"lines_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        with freed_shuffles(spark):
            lines.write.bucketBy(buckets, "k").option("path", f"{folder}/lines").option("compression", "zstd").saveAsTable(self.name)
        self.table = spark.table(self.name)
        self.texts = self.table

    def only(self, pairs: DataFrame, folder: str) -> None:
        """From now on only lines in these pairs are compared: their texts go to a table of their own."""
        wanted = pairs.select(F.col("u").alias("w")).unionByName(pairs.select(F.col("v").alias("w"))).distinct()
        self.texts = written(wanted.join(self.table, F.col("w") == F.col("k")).select("k", "line"), f"{folder}/texts", codec="zstd")

    def compared(self, pairs: DataFrame, folder: str, size: int, threshold: float, turn: int) -> DataFrame:
        """(u, v, similar, marks) of pairs, a row for each side in the first turn; v may be a hot key. ``marks`` name what sets u apart from v, if others were compared
        with v too: what v leads alone has nobody left to meet."""
        text = self.texts.select("k", "line")
        led = pairs.groupBy("v").agg((F.count(F.lit(1)) > 1).alias("several"))
        right = led.join(text, F.col("v") == F.col("k")).select("v", "several", F.col("line").alias("b"))
        right = written(right, f"{folder}/right")
        left = pairs.join(text, F.col("u") == F.col("k")).select("u", "v", F.col("line").alias("a"))
        left = written(left, f"{folder}/left")
        # Through generators: what is used more than once is made once a pair. The differences of x and y are sets, repeated hashes or not.
        sets = F.struct(shingles(F.col("a"), size).alias("x"), shingles(F.col("b"), size).alias("y"))
        both = left.join(right, "v").select("u", "v", "several", F.inline(F.array(sets)))
        more = F.struct(F.array_except("x", "y").alias("more"), F.array_except("y", "x").alias("less"), F.size(F.array_distinct("x")).alias("n"))
        apart = both.select("u", "v", "several", F.inline(F.array(more)))
        common = F.col("n") - F.size("more")
        similar = common >= F.lit(threshold) * (F.col("n") + F.size("less"))
        sides = [
            F.struct(F.lit(name == "less").alias("less"), F.when(F.col("several"), F.col(name)).alias("set"))
            for name in (["more", "less"] if turn == 0 else ["more"])
        ]
        sided = apart.select("u", "v", "several", similar.alias("similar"), F.inline(F.array(*sides)))
        return written(_marked(sided, turn), f"{folder}/compared")

    def drop(self) -> None:
        """Forgets the table's name; its files stay in the work folder."""
        self.table.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def _marked(sided: DataFrame, turn: int) -> DataFrame:
    """(u, v, similar, marks) for each pair and side: ``MARKS`` names for its set of hashes, each from two neighbours in a ring of
    MinHash components; none for an empty set, null without ``several``.

    The smallest hashes are found by aggregation, in generated code. Its key is not v, by which the rows are dealt, so that Spark can
    still split a hot v: rows of a pair lie in one task, which sends one row on.
    """
    draws = [random.Random(turn), random.Random(-1)]
    points = [[draw.getrandbits(64) - 2**63 for _ in range(MARKS)] for draw in draws]
    point = lambda i: F.when(F.col("less"), F.lit(points[1][i])).otherwise(F.lit(points[0][i]))
    at = sided.select("u", F.bitwise_not("v").alias("w"), "several", "similar", "less", F.explode_outer("set").alias("x"))
    lowest = [F.min(F.col("x").bitwiseXOR(point(i))).alias(f"c{i}") for i in range(MARKS)]
    found = at.groupBy("u", "w", "several", "similar", "less").agg(*lowest)
    side = F.when(F.col("less"), F.lit("less")).otherwise(F.lit("more"))
    names = F.array(*[F.xxhash64(side, F.lit(i), F.col(f"c{i}"), F.col(f"c{(i + 1) % MARKS}")) for i in range(MARKS)])
    some = F.when(F.col("c0").isNotNull(), names).otherwise(F.array().cast("array<bigint>"))
    return found.select("u", F.bitwise_not("w").alias("v"), "similar", F.when(F.col("several"), some).alias("marks"))


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per line with a word: id, line_no, class_id, class_line (first place of its class), class_size, kept."""
    folder = work_folder(docs.sparkSession, "lines")
    lines = lines_of(docs, id_col, text_col)
    distinct = lines.groupBy("k").agg(F.min("line").alias("line"), F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "line_no")).alias("first"))
    table = _Lines(distinct, folder)
    # The table is bucketed by k, so signatures need no exchange. Lines with few shingles count too: a set may hold the
    # other, or equal it where shingles repeat.
    long = table.table.filter(F.length("line") >= shingle).select("k", "line")
    met = written(_band_keys(long, shingle, bands, rows).select("sk", F.explode("bands").alias("band")).withColumnRenamed("sk", "k"), f"{folder}/bands")
    group = components(_links(table, met, folder, shingle, threshold))
    known = table.table.select("k", "n", "first")
    member = written(known.join(group, F.col("k") == F.col("node")).select("k", "n", "first", "component"), f"{folder}/member")
    whole = member.groupBy("component").agg(F.sum("n").alias("total"), F.min("first").alias("start"))
    joined = member.join(whole, "component").select(F.col("k").alias("mk"), "total", "start")
    places = written(
        known.join(joined, F.col("k") == F.col("mk"), "left").select(
            F.col("k").alias("pk"), F.coalesce("total", "n").alias("class_size"), F.coalesce("start", "first").alias("start")
        ),
        f"{folder}/places",
    )
    table.drop()
    found = lines.select("id", "line_no", "k").join(places, F.col("k") == F.col("pk"))
    return found.select(
        F.col("id").alias(id_col), "line_no", F.col("start.id").alias("class_id"), F.col("start.line_no").alias("class_line"),
        "class_size",
        (F.col("id").eqNullSafe(F.col("start.id")) & (F.col("line_no") == F.col("start.line_no"))).alias("kept"),
    )


def _links(lines: _Lines, rows: DataFrame, folder: str, size: int, threshold: float) -> DataFrame:
    """Verified links (u, v) that connect the similar lines of each bucket; ``rows`` has (k, band)."""
    shared = written(rows.groupBy("band").count().filter("count > 1").select("band"), f"{folder}/shared")
    met = written(rows.join(shared, "band"), f"{folder}/met")
    members = written(met.join(lines.table.select("k", "n"), "k"), f"{folder}/members")
    leader = written(members.groupBy("band").agg(F.max_by("k", F.struct("n", "k")).alias("leader")), f"{folder}/leaders")
    led = members.join(leader, "band").filter("k <> leader")
    pairs = written(led.select(F.col("k").alias("u"), F.col("leader").alias("v")).distinct(), f"{folder}/pairs")
    lines.only(pairs, folder)
    found = lines.compared(pairs, f"{folder}/first", size, threshold, 0)
    links = found.filter("similar").select("u", "v")
    # ``home`` is a line that u is known to be linked with, or u itself.
    home = F.when(F.col("similar"), F.col("v")).otherwise(F.col("u"))
    dealt = _dealt(found.select(F.col("v").alias("bucket"), "u", home.alias("home"), "marks"))
    turn = 0
    while True:
        turn += 1
        at = f"{folder}/round-{turn}"
        dealt = written(dealt, f"{at}/dealt")
        # Lines that share one name often share them all: of buckets with the same lines one is enough.
        same = [F.count(F.lit(1)).alias("n"), *[F.bit_xor(F.xxhash64(F.lit(i), "u")).alias(f"x{i}") for i in (0, 1)]]
        open_ = dealt.groupBy("bucket").agg(
            F.min("home").alias("low"), F.max("home").alias("high"), F.max_by("u", F.struct(F.col("home") == F.col("u"), "u")).alias("v"), *same
        ).filter("low < high").groupBy("v", "n", "x0", "x1").agg(F.min("bucket").alias("bucket")).select("bucket", "v")
        open_ = written(open_, f"{at}/open")
        led = written(dealt.join(open_, "bucket").filter("u <> v"), f"{at}/led")
        pairs = written(led.select("u", "v").distinct(), f"{at}/pairs")
        if pairs.isEmpty():
            return links
        found = lines.compared(pairs, at, size, threshold, turn)
        links = links.unionByName(found.filter("similar").select("u", "v"))
        home = F.when(F.col("similar"), F.col("v")).otherwise(F.col("home"))
        dealt = _dealt(led.join(found, ["u", "v"]).select("bucket", "u", home.alias("home"), "marks"))


def _dealt(members: DataFrame) -> DataFrame:
    """(u, home, bucket): the members of each bucket, without its leader, dealt to buckets of their own by their marks.

    A bucket whose members all belong together by now is done, since buckets come from one bucket.
    """
    homes = members.groupBy("bucket").agg(F.min("home").alias("low"), F.max("home").alias("high"))
    apart = members.join(homes.filter("low < high").select("bucket"), "bucket")
    return apart.select("u", "home", F.explode("marks").alias("mark"), "bucket").select("u", "home", F.xxhash64("bucket", "mark").alias("bucket"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows with the lines that do not stay taken out of their texts; ids must be unique. Null texts stay null."""
    rows, at = numbered(docs)
    ident, text = at[id_col], at[text_col]
    gone = line_classes(rows, ident, text, **options).filter("not kept").groupBy(F.col(ident).alias("_gone_id")).agg(
        F.collect_list("line_no").alias("_gone")
    )
    left = rows.join(gone, rows[ident].eqNullSafe(gone["_gone_id"]), "left")
    rest = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda line, i: ~F.array_contains("_gone", i)), "\n")
    return renamed(left.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(rest)), docs)
