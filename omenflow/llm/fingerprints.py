"""Document fingerprints by invertible Bloom lookup sketches.  DataFrame functions only.

Every text is cut alike into paragraphs, whatever its length: at line breaks and after the ends of sentences, so that
long texts of few lines can be compared too, and a sentence has the same digest in a long and in a short text.  The
distinct 56-bit digests of its paragraphs go into a sketch of three parts of 16 cells; a digest goes into one cell of each
part.  A cell has the number of its digests and their exclusive or; a part of a digest's bits checks the
others.  Two versions' sketches are subtracted cell by cell, which leaves the digests that differ; peeling recovers
these: a cell that holds a single digest (its check fits) gives it away, it is taken out of its other cells, and so on
until all cells are empty.
If some are left, both texts are sketched again larger, as several tables of three parts of 32 cells, among which digests
are dealt, with about ``LOAD`` digests a table.  A table that fails is sketched again as four, whose digests go to other
cells, and so on (``RETRIES`` attempts; after that its digests are compared
one by one).  The likeness of two versions is the share of their paragraphs that both have.

The fingerprint is the first sketch, as text.  The next document in descending order of ids is found without a global
sort of texts: ids are cut into ranges by approximate quantiles and, on larger tables, further by their values (an id that
many rows share by the hashes of their texts); each range has the first row of the range below it as a guest, and one
shuffle of the texts by range does the rest.

Cases: null and empty texts have no paragraphs and an empty sketch; two of them have the likeness 1; rows with the same
id are ordered by their texts' hashes; a single row is its own next; a null id comes after all others; an empty table
gives an empty result; very long texts are read whole; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import spread, table

#: Cells of a part of the first sketch and of a larger one's tables (in bits), and digests of two versions that a table is meant for.
FIRST, WIDE = 4, 5
LOAD = 44
#: Digests that a table has at most, about: counts have 8 bits.
MOST = 1024
RETRIES = 4
ROUNDS = 8
#: Ranges of ids: the coarse ones, rows that a range is to have, and about how many ranges there are at most.
RANGES, RANGE_ROWS, MOST_RANGES = 1024, 2500, 1 << 18
#: Rows that a task has at most, on average.
TASK_ROWS = 20_000
#: White space after the end of a sentence, which keeps its full stop, and around line breaks.
SENTENCE = r"\\s(?<=[.!?]\\s)\\s*|\\s*\\n\\s*"
#: A digest has 36 bits of the paragraph's hash and 20 bits that check these.  The 8 bits above are for a count: 1 and -1 in
#: a digest that is put into a difference's cells, or taken out of them.
LOW, HASH, CHECK, ONE = (1 << 56) - 1, (1 << 56) - (1 << 20), (1 << 20) - 1, 1 << 56


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is then evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def check(key: str) -> str:
    return f"(xxhash64({key} & {HASH}L, 1) & {CHECK}L)"


def paragraphs(text: str) -> str:
    """Distinct digests of the paragraphs of a text."""
    hashes = f"transform(filter(split({text}, '{SENTENCE}'), x -> x <> ''), x -> xxhash64(x))"
    return f"array_distinct(transform({hashes}, h -> (h & {HASH}L) | {check('h')}))"


def source(key: str, attempt: int) -> str:
    """The bits, from the 20th, that say where a digest goes: its own, in later attempts those of another hash."""
    return key if attempt < 2 else f"xxhash64({key} & {LOW}L, {attempt})"


def cells(digests: str, bits: int, attempt: int, signed: bool) -> str:
    """The cells of one table, each a count above the exclusive or of its digests.

    Each part's digests are dealt over groups of cells first, then over the cells of a group.  ``signed`` digests have a
    count of their own, 1 or -1, so that the cells are those of a difference: sketches are linear.
    """
    add = f"aggregate({{}}, 0L, (t, p) -> (t + (p & {~LOW}L)) ^ (p & {LOW}L))" if signed else "{}"
    parts = []
    for j in range(3):
        low = 20 + bits * j
        middle = low + bits - bits // 2
        numbers = lambda n, at: "array(" + ", ".join(f"{i << at}L" for i in range(n)) + ")"
        within = f"filter(few, p -> {source('p', attempt)} & {(1 << middle) - (1 << low)}L = i)"
        one = add.format(within) if signed else let("c", within, "shiftleft(bigint(size(c) % 64), 56) | aggregate(c, 0L, (t, p) -> t ^ p)")
        few = f"filter({digests}, p -> {source('p', attempt)} & {(1 << low + bits) - (1 << middle)}L = v)"
        group = let("few", few, f"transform({numbers(1 << bits - bits // 2, low)}, i -> {one})")
        parts.append(f"flatten(transform({numbers(1 << bits // 2, middle)}, v -> {group}))")
    return f"concat({', '.join(parts)})"


def subtract(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> (x - (y & {~LOW}L)) ^ (y & {LOW}L))"


def peel(difference: str, bits: int, attempt: int) -> str:
    """``ok, a, b``: whether all digests were recovered, and how many only the first and only the second version has."""
    size = 1 << bits
    here = f"shiftrightunsigned({source('x', attempt)}, 20 + {bits} * (i div {size})) & {size - 1}L = i % {size}"
    alone = f"(x & {~LOW}L = {ONE}L OR x & {~LOW}L = {-ONE}L) AND {here} AND (x & {CHECK}L) = {check('x')}"
    found = f"array_distinct(filter(s.c, (x, i) -> {alone}))"
    after = f"named_struct('c', {subtract('s.c', cells('u', bits, attempt, True))}, 'a', s.a + size(filter(u, q -> q > 0L)), 'b', s.b + size(filter(u, q -> q < 0L)), 'go', true)"
    done = "named_struct('c', s.c, 'a', s.a, 'b', s.b, 'go', false)"
    loop = f"aggregate(sequence(1, {ROUNDS}), named_struct('c', {difference}, 'a', 0, 'b', 0, 'go', true), (s, r) -> if(s.go, {let('u', found, f'if(size(u) = 0, {done}, {after})')}, s))"
    return let("e", loop, "named_struct('ok', forall(e.c, x -> x = 0L), 'a', e.a, 'b', e.b)")


def table_of(both: str, attempt: int) -> str:
    """What ``peel`` finds in one table of the signed digests of two versions: counts, or on failure the digests, to be sketched again."""
    once = peel(cells(both, WIDE, attempt, True), WIDE, attempt)
    return let("f", once, f"if(f.ok, named_struct('a', f.a, 'b', f.b, 'x', cast(array() AS array<bigint>)), named_struct('a', -1, 'b', -1, 'x', {both}))")


def gathered(tables: str, a: str = "0", b: str = "0") -> str:
    """Counts of the tables that were peeled, and the tables that weren't."""
    total = lambda of: f"aggregate(z, {{}}, (t, x) -> t + if(x.{of} < 0, 0, x.{of}))"
    return let("z", tables, f"named_struct('a', {total('a').format(a)}, 'b', {total('b').format(b)}, 'open', filter(z, x -> x.a < 0))")


def larger(a: str, b: str, difference: str) -> str:
    """A larger sketch of the difference of two sets, as several tables.

    Their number follows from the first sketch: a digest that only one version has adds 1 on average to the sum of the
    squared counts of each part (counts are modulo 64 there, so that the difference in sizes is looked at too).  Tables are in groups, so that a digest is looked at about twice the root of their number.
    """
    squares = f"aggregate({difference}, 0D, (t, x) -> t + double(shiftright(x, 56)) * shiftright(x, 56))"
    number = f"int(greatest(1.0D, ceil({squares} / {3 * LOAD}D), ceil(abs(size({a}) - size({b})) / {LOAD}D), ceil((size({a}) + size({b})) / {MOST}D)))"
    one = let("px", f"filter(ga, p -> shiftright(p & {LOW}L, 35) div g % h = v)", table_of("px", 1))
    group = let("ga", f"filter(xs, p -> shiftright(p & {LOW}L, 35) % g = w)", f"transform(sequence(0, h - 1), v -> {one})")
    each = f"flatten(transform(sequence(0, g - 1), w -> {group}))"
    sized = let("m", number, let("g", "int(ceil(sqrt(m)))", let("h", "int(ceil(m / double(g)))", each)))
    return gathered(let("xs", f"concat(transform({a}, p -> p | {ONE}L), transform({b}, p -> p | {-ONE}L))", sized))


def again(state: str, attempt: int) -> str:
    """Each open table as four, whose digests go to other cells."""
    each = let("px", f"filter(o.x, p -> xxhash64(p & {LOW}L, {-attempt}) & 3 = w)", table_of("px", attempt))
    return f"if(size({state}.open) = 0, {state}, {gathered(f'flatten(transform({state}.open, o -> transform(sequence(0, 3), w -> {each})))', f'{state}.a', f'{state}.b')})"


def text_of(first: str, digests: str) -> str:
    """A sketch as a string."""
    return f"concat(string(size({digests})), '/', array_join(transform({first}, x -> lower(hex(x))), '/'))"


def _range_of(key: Column, h: Column, cuts: list[int], least: int, most: int, each: int) -> Column:
    """A number that grows with ``(key, h)``: coarse ranges by ``cuts``, of ``each`` equal parts of their keys.

    A cut that comes several times is a key with as many ranges' rows; these are parted by ``h``.
    """
    times = Counter(cuts)
    bounds = [least, *sorted(x for x in times if x > least)]
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    reached = lambda xs: F.size(F.filter(xs, lambda b: b <= key))
    coarse = F.greatest(F.lit(1), reached(F.array(*[F.lit(p[0]) for p in parts])))
    fine = F.get(F.array(*[F.array(*map(F.lit, p)) for p in parts]), coarse - 1)
    number = (coarse - 1) * step + F.greatest(F.lit(1), reached(fine)) - 1
    begin = F.get(F.array(*map(F.lit, bounds)), number)
    end = F.get(F.array(*map(F.lit, [*bounds[1:], most])), number)
    width = F.greatest(end.cast("double") - begin.cast("double"), F.lit(1.0))
    inner = F.least(F.lit(each - 1), F.floor((key.cast("double") - begin.cast("double")) / width * each)).cast("long")
    heavy = {b: n * each for b, n in times.items() if n > 1}
    place = each * len(cuts) + inner  # after all parts of a heavy key
    if heavy:
        shares = F.create_map(*[F.lit(x) for b, n in heavy.items() for x in (b, n)])[key]
        place = F.when(shares.isNotNull(), F.floor((h.cast("double") / 2.0**64 + 0.5) * shares).cast("long")).otherwise(place)
    return number.cast("long") * (2 * each * len(cuts) + each + 1) + place


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, next_text``: each row and the one after it in descending order of ids (the first after the last).

    Columns named in ``also`` come along, and those of the next row as ``next_<name>``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    narrow = docs.select(key.alias("key"))
    sizes = narrow.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("cuts"), F.min("key").alias("least"), F.max("key").alias("most"), F.count("*").alias("n")).first()  # bounded
    each = max(1, min(MOST_RANGES // ranges, -(-sizes.n // (ranges * RANGE_ROWS))))
    at = _range_of(F.col("key"), F.col("h"), sizes.cuts or [], sizes.least or 0, sizes.most or 0, each)
    placed = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.xxhash64(text).alias("h"), text.alias("text"), *also).withColumn("range", at)
    tops = placed.groupBy("range").agg(F.max(F.struct("key", "h")).alias("t")).orderBy(F.desc("range")).collect()  # one a range
    guests = [(r.range, after.t.key, after.t.h) for r, after in zip(tops, [*tops[1:], *tops[:1]], strict=True)]
    known = docs.sparkSession.createDataFrame(guests, "guest_of long, key long, h long")
    # At most one row for each range.
    dealt = placed.join(F.broadcast(known), ["key", "h"], "left")
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    other = F.struct(F.col("guest_of").alias("range"), F.lit(True).alias("guest"))
    carried = ["doc_id", "key", "h", "text", *also]
    dealt = dealt.select(*carried, F.explode(F.when(F.col("guest_of").isNull(), F.array(own)).otherwise(F.array(own, other))).alias("at"))
    dealt = dealt.select(*carried, "at.*")
    dealt = spread(dealt, sizes.n // TASK_ROWS, "range")
    order = Window.partitionBy("range").orderBy("guest", F.desc("key"), F.desc("h"))
    after = {f"next_{c}": F.lead(c).over(order) for c in ("text", *also)}
    return dealt.withColumns(after).where("not guest").select("doc_id", "text", *also, *(F.coalesce(f"next_{c}", c).alias(f"next_{c}") for c in ("text", *also)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, n_paragraphs`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.expr(paragraphs("text")).alias("p"))
    return rows.select("doc_id", F.expr(text_of(cells("p", FIRST, 0, False), "p")).alias("fingerprint"), F.size("p").alias("n_paragraphs"))


def compare_versions(pairs: DataFrame, *others: str, digests: dict[str, str] | None = None) -> DataFrame:
    """Adds ``fingerprint``, and for each other text column ``<name>_fingerprint`` and ``<name>_likeness``, to ``pairs`` (with ``text``).

    The likeness is the share of paragraphs that two versions have in common.  ``digests`` names columns that have
    ``paragraphs`` of a text column already.  Each step is a projection of its own, whose columns the next ones read
    more than once, so that Spark does none of them twice.
    """
    numbered = dict(enumerate(["text", *others]))
    known = digests or {}
    keep = [F.col(c) for c in pairs.columns]
    rows = pairs.select(*keep, *((F.col(known[name]) if name in known else F.expr(paragraphs(name))).alias(f"_p{i}") for i, name in numbered.items()))
    rows = rows.select("*", *(F.expr(cells(f"_p{i}", FIRST, 0, False)).alias(f"_c{i}") for i in numbered))
    rows = rows.select("*", *(F.expr(subtract("_c0", f"_c{i}")).alias(f"_s{i}") for i in numbered if i))
    rows = rows.select("*", *(F.expr(peel(f"_s{i}", FIRST, 0)).alias(f"_d{i}") for i in numbered if i))
    kept = [*keep, *(f"_{x}{i}" for i in numbered for x in "pc")]
    done = "named_struct('a', _d{i}.a, 'b', _d{i}.b, 'open', cast(array() AS array<struct<a: int, b: int, x: array<bigint>>>))"
    rows = rows.select(*kept, *(F.expr(f"if(_d{i}.ok, {done.format(i=i)}, {larger('_p0', f'_p{i}', f'_s{i}')})").alias(f"_d{i}") for i in numbered if i))
    for attempt in range(2, RETRIES + 1):
        rows = rows.select(*kept, *(F.expr(again(f"_d{i}", attempt)).alias(f"_d{i}") for i in numbered if i))
    # What is still left is compared digest by digest.
    side = lambda sign: f"transform(filter(o.x, p -> p {sign} 0L), p -> p & {LOW}L)"
    left = "_d{i}.{n} + aggregate(_d{i}.open, 0, (t, o) -> t + size(array_except({x}, {y})))"
    rows = rows.select(*kept, *(F.expr(left.format(i=i, n=n, x=side(x), y=side(y))).alias(f"_{n}{i}") for i in numbered if i for n, x, y in ("a><", "b<>")))
    outs = [F.expr(text_of("_c0", "_p0")).alias("fingerprint")]
    for i, name in numbered.items():
        if i:
            share = f"if(size(_p0) + _b{i} = 0, 1.0D, double(size(_p0) - _a{i}) / (size(_p0) + _b{i}))"
            outs += [F.expr(text_of(f"_c{i}", f"_p{i}")).alias(f"{name}_fingerprint"), F.expr(share).alias(f"{name}_likeness")]
    return rows.select(*keep, *outs)


def op6_paragraph_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", F.expr(paragraphs("coalesce(text, '')")).alias("p"))
    rows = with_next(docs, also=("p",))
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - k), F.substring("next_text", F.lit(1), k))
    rows = rows.select("doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"), "next_text", "p", "next_p")
    out = compare_versions(rows, "edited", "next_text", digests={"text": "p", "next_text": "next_p"})
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", F.col("edited_likeness").alias("near_edited"), F.col("next_text_likeness").alias("near_next"))
