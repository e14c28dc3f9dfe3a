"""Near-duplicate lines over all documents, by a segment-partition edit join in built-in SQL alone.

Two lines are alike if the longer one, of n characters, is turned into the other by at most ``allowed(n)`` edits (one
character inserted, deleted or replaced), a number that grows with the length in the steps of ``CLASSES``. A line is
cut into one even segment more than the edits that are allowed; whatever is within so many edits of it holds at least
one segment unchanged. Its segments, with their number and the line's length, are its index keys. A line probes the
indexes of all lengths that it may be the longer one for: for a length and a segment only the substrings that lie so that
the edits to their left and to their right can make up for both, the multi-match-aware bounds of such joins. No pair
can be missed, and a line has 6 keys with one edit and some 60 with four, whatever its length. A line that is
just short of a class is also indexed for that class, as the shorter one of a pair.

Most probes meet nothing. A Bloom filter of the index keys, one 64-bit block and two bits a key, is a table of blocks;
below a counted size it is broadcast, and only probes that it lets pass are kept and shuffled. It only ever spares work.

What meets is compared by length and by counts of letters, which are necessary conditions, then by a banded bit-parallel
edit distance, after the common starts and ends are cut off. Where near copies of a line share a bucket without being alike,
counts before and after cuts tell them apart, and a pair is compared in few of the buckets that it shares (``narrow``).

Alike lines form groups; the first line of a group (smallest doc_id, then text hash, then place) stays and the others
are removed from their documents, exact repeats included. Lines shorter than ``MIN_CHARS`` always stay.

Lines are named by 64-bit hashes. Should two different lines share a name, they are compared as one; the second hash
that each removal checks keeps a line from being removed for another's sake.

Defined cases: a null text stays null; lines end at ``\\n``; a text keeps its other lines, joined by ``\\n``; rows equal
in id and text are treated alike, so that both keep or lose a line; a null id comes first. Other columns stay; n_chars,
if there is one, is set anew where lines went. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as Over, functions as F

from cellframe.llm.linking import Narrow, Near, Sides, link
from cellframe.llm.shared import BROADCAST_ROWS, keep, small, table

MIN_CHARS = 30
#: (length of the longer line from which, edits that are allowed).
CLASSES = ((MIN_CHARS, 1), (80, 2), (160, 3), (320, 4))
#: Blocks of the Bloom filter, at most; each is 64 bits, meant for 8 keys. With more keys it lets more probes pass.
BLOOM_BLOCKS = 1 << 20
#: Their counts are compared before lines are aligned; an edit changes the sum of differences by at most two.
LETTERS = "etaoinshrdlucmfwygpbvk.,"
#: A line is cut in two at the ends of all but the last of so many even parts, see ``narrow``.
PARTS = 16
#: Members of a bucket up to which they are compared without cuts.
FEW = 16
#: Letters whose counts before and after a cut are put into one word, 3 bits each; all other characters are one more class.
CUT_LETTERS = LETTERS[:20]


def lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, place, line, id) of the lines that are compared."""
    return docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("place", "line")
    ).where(F.length("line") >= min_chars).withColumn("id", F.xxhash64("line"))


Classes = tuple[tuple[int, int], ...]


def classes(max_edits: int | None, min_chars: int) -> Classes:
    """The steps of allowed edits; ``max_edits`` allows one number for lines of any length."""
    steps = CLASSES if max_edits is None else ((min_chars, max_edits),)
    if any(max(start, min_chars) <= 2 * k for start, k in steps):
        raise ValueError("lines must be longer than twice the edits they are allowed")
    return steps


def allowed(n: int, steps: Classes = CLASSES) -> int:
    return max(k for start, k in steps if n >= start or start == steps[0][0])


def allowed_sql(n: str, steps: Classes) -> str:
    whens = " ".join(f"WHEN {n} >= {start} THEN {k}" for start, k in reversed(steps[1:]))
    return f"(CASE {whens} ELSE {steps[0][1]} END)" if whens else str(steps[0][1])


def windows(k: int) -> list[tuple[int, int, int]]:
    """(segment, how much shorter the indexed line is, how far right of the segment's place) of all probes."""
    found = []
    for segment in range(k + 1):
        for shorter in range(k + 1):
            low = max(-segment, shorter - (k - segment))
            high = min(segment, shorter + (k - segment))
            found += [(segment, shorter, shift) for shift in range(low, high + 1)]
    return found


Window = tuple[int, int, int, int]


def index_windows(k: int) -> list[Window]:
    return [(k, segment, 0, 0) for segment in range(k + 1)]


def probe_windows(k: int) -> list[Window]:
    """Without those that are index windows too."""
    return [(k, *window) for window in windows(k) if window[1:] != (0, 0)]


def _by_size(steps: Classes, *kinds: tuple[Callable[[int], list[Window]], bool]) -> str:
    """SQL: the windows of the classes that ``size`` falls into, for each (windows of k, whether from k before a class starts).

    One constant list for each range of sizes, null outside: nothing is put together for a line.
    """
    ends = [start for start, _ in steps[1:]]
    bounds = sorted({bound for start, k in steps for bound in (start - k, start)})
    found = []
    for low, high in reversed([*zip(bounds, [*bounds[1:], None])]):
        rows = ", ".join(
            f"named_struct('k', {w[0]}, 'segment', {w[1]}, 'shorter', {w[2]}, 'shift', {w[3]})"
            for windows_of, earlier in kinds
            for (start, k), end in zip(steps, [*ends, None])
            if low >= (start - k if earlier else start) and (end is None or low < end)
            for w in windows_of(k)
        )
        found += [f"WHEN size >= {low} THEN array({rows})"] if rows else []
    return f"CASE {' '.join(found)} END"


#: The bit of a key that says whether its segment is the first of its line.
_OF_FIRST = "shiftleft(1L, 62)"


def keys(lines: DataFrame, windows: str) -> DataFrame:
    """(id, key): the key of each window of each line, the substring that lies like a segment of a line ``shorter``.

    Characters of one width are found without walking to them; behind a generator they are made once for a line.
    """
    sized = lines.selectExpr("id", "inline(array(named_struct('size', length(line), 'units', encode(line, 'UTF-32'))))")
    placed = sized.selectExpr("id", "size", "units", f"inline({windows})")
    start, end = (f"CAST((segment + {i}) * (size - shorter) div (k + 1) AS INT)" for i in (0, 1))
    units = f"substring(units, 4 * ({start} + shift) + 1, 4 * ({end} - {start}))"
    key = f"xxhash64(k, segment, size - shorter, {units})"
    return placed.selectExpr("id", f"{key} & ~{_OF_FIRST} | if(segment = 0, {_OF_FIRST}, 0L) AS key")


_BITS = "(shiftleft(1L, CAST(pmod(shiftright(key, 32), 64) AS INT)) | shiftleft(1L, CAST(pmod(shiftright(key, 40), 64) AS INT)))"


def buckets(known: DataFrame, steps: Classes, broadcast_rows: int) -> DataFrame:
    """(key, id) of all index keys of the lines of ``known`` (id, line), and of the probes that may meet one."""
    n = known.count() * (steps[-1][1] + 1)  # index keys, at most but for those around the bounds of classes
    blocks = min(BLOOM_BLOCKS, 1 << max(6, (n // 8).bit_length()))
    as_index, as_probe = (index_windows, True), (probe_windows, False)
    bloom = keep(
        keys(known, _by_size(steps, as_index)).selectExpr(f"pmod(key, {blocks}) AS block", f"{_BITS} AS bits").groupBy("block")
        .agg(F.expr("bit_or(bits)").alias("word"))
    )
    probes = keys(known, _by_size(steps, as_index, as_probe))
    met = F.expr(f"block = pmod(key, {blocks}) AND (word & {_BITS}) = {_BITS}")
    return keep(probes.join(small(bloom, broadcast_rows), met, "left_semi").select("key", "id"))


def within(a: str, b: str, k: int) -> str:
    """SQL: whether two arrays of characters, the first not shorter, are within k (at most 30) edits.

    Bit r of the vectors stands for row j - k + r in column j; ``vp`` and ``vn`` say where the distance rises or falls
    from the row above. The sum of the diagonal that ends in the last cell is followed.
    """
    full = (1 << (2 * k + 1)) - 1
    equal = " | ".join(f"if(get({a}, _j - {k - r} - 1) = {b}[_j - 1], {1 << r}L, 0L)" for r in range(2 * k + 1))
    d0 = "(((_v.eq & _v.vp) + _v.vp) ^ _v.vp | _v.eq | _v.vn)"
    hp = f"((_v.vn | ~({d0} | _v.vp)) & {full}L)"
    hn = f"({d0} & _v.vp)"
    lower = f"shiftright({d0} & {full}L, 1)"
    vp = f"(({hn} | ~({lower} | {hp})) & {full}L)"
    vn = f"({lower} & {hp})"
    apart = f"(size({a}) - size({b}))"
    step = (
        f"transform(array(named_struct('eq', {equal}, 'vp', _s.vp, 'vn', _s.vn)), _v -> named_struct('vp', {vp}, 'vn', {vn}, "
        f"'d', _s.d + if(shiftright({d0}, {k} + {apart}) & 1L = 1L, 0, 1)))[0]"
    )
    first = ((1 << k) - 1) << k  # rows 1 to k of column 0, seen from the window of column 1
    start = f"named_struct('vp', {first}L, 'vn', 0L, 'd', {apart})"
    return (
        f"({apart} <= {k} AND CASE WHEN size({b}) = 0 THEN true ELSE "
        f"aggregate(sequence(1, size({b})), {start}, (_s, _j) -> {step}, _s -> _s.d <= {k}) END)"
    )


def common_start(a: str, b: str) -> str:
    """SQL: how many characters two strings begin with alike, found by halving."""
    step = "CAST(shiftleft(1L, _e) AS INT)"
    return (
        f"aggregate(sequence(CAST(ceil(log2(length({a}) + 1)) AS INT), 0, -1), 0, (_c, _e) -> _c + if("
        f"_c + {step} <= least(length({a}), length({b})) AND "
        f"substring({a}, _c + 1, {step}) = substring({b}, _c + 1, {step}), {step}, 0))"
    )


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` for a value that is worked out once, wherever the optimizer moves it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def characters(text: str) -> str:
    return f"if({text} = '', CAST(array() AS array<string>), split({text}, ''))"


def alike(one: str, two: str, k: int) -> str:
    """SQL: whether two strings are within k edits. What they begin and end with alike is cut off first."""
    longer = f"if(length({one}) >= length({two}), {one}, {two})"
    shorter = f"if(length({one}) >= length({two}), {two}, {one})"

    def rest(of: str, same: str, then: str) -> str:
        return "named_struct(" + ", ".join(f"'{c}', " + then.format(f"substring({of}.{c}, {same} + 1)") for c in "xy") + ")"

    aligned = _let("_t", f"named_struct('x', {characters('_r.x')}, 'y', {characters('_r.y')})", within("_t.x", "_t.y", k))
    inner = _let("_r", rest("_q", "_m", "{}"), aligned)
    turned = _let("_q", rest("_p", "_n", "reverse({})"), _let("_m", common_start("_q.x", "_q.y"), inner))
    return _let("_p", f"named_struct('x', {longer}, 'y', {shorter})", _let("_n", common_start("_p.x", "_p.y"), turned))


def letter_counts() -> list[Column]:
    return [F.expr(f"length(line) - length(replace(line, '{c}', ''))").alias(f"c{i}") for i, c in enumerate(LETTERS)]


def cut_words(texts: DataFrame) -> DataFrame:
    """(id, step, words): for a line (id, step, line) the letter counts before and after each ``step`` characters, a word each.

    Every class of characters has 3 bits, which stand for its count modulo 6 such that one more changes one bit. So two
    words differ in no more bits than the counts that they stand for differ by in all.
    """
    last = PARTS - 1
    part = f"substring(line, p * step + 1, if(p < {last}, step, length(line)))"
    parts = texts.selectExpr("id", "step", f"posexplode(transform(sequence(0, {last}), p -> {part})) AS (part, text)")
    letters = [F.expr(f"length(text) - length(replace(text, '{c}', ''))") for c in CUT_LETTERS]
    counts = {f"c{i}": c for i, c in enumerate([*letters, F.length("text")])}
    counted = parts.select("id", "step", "part", *[c.alias(name) for name, c in counts.items()])
    line = Over.partitionBy("id", "step")
    before = line.orderBy("part").rowsBetween(Over.unboundedPreceding, Over.currentRow)
    summed = counted.select(
        "id", "step", "part", *[F.sum(c).over(before).alias(f"l{c}") for c in counts],
        *[(F.sum(c).over(line) - F.sum(c).over(before)).alias(f"r{c}") for c in counts],
    ).where(f"part < {last}")

    def word(side: str) -> str:
        of = [f"{side}{c}" for c in counts]
        of[-1] = f"({of[-1]} - {' - '.join(of[:-1])})"
        return " | ".join(f"shiftleft(shiftright(shiftleft(7L, CAST({c} % 6 AS INT)), 3) & 7L, {3 * i})" for i, c in enumerate(of))

    words = summed.selectExpr("id", "step", "part", f"{word('l')} AS l", f"{word('r')} AS r")
    return words.groupBy("id", "step").agg(
        F.expr("flatten(transform(sort_array(collect_list(struct(part, l, r))), x -> array(x.l, x.r))) AS words")
    )


def narrow(near: Near, steps: Classes, broadcast_rows: int, few: int = FEW) -> Narrow:
    """What lines of a bucket are compared by once the hubs have linked what they can; it holds for every alike pair.

    * The bucket is that of the shorter line's own segment, so this line is one of the shortest of the bucket.
    * In a bucket of more than ``few`` members: if the lines begin with the same segment, it is the bucket of this one, as no
      alignment is better than one that keeps a common start.
    * There too: cut both lines at one place. With e edits before it, that move the place by d characters, letter counts before
      it differ by at most 2e in sum. With f edits after it, counts there differ by at most 2f + |d| - |s - d| if the lines'
      sizes differ by s. Both together are no more than 2k + |s|, at every cut. Lines that part from a third one at far places
      fail there, although all their letters together may be the same.
    """
    last = PARTS - 1

    def sides(rest: DataFrame, described: DataFrame) -> list[Sides]:
        bucket = Over.partitionBy("key")
        rest = keep(rest.select(
            "key", "id", "label", F.col("of").dropFields("line").alias("of"), F.min("of.size").over(bucket).alias("least"),
            F.count("id").over(bucket).alias("n"),
        ))
        small_ones = rest.where(f"n <= {few}")
        large = rest.where(f"n > {few}").selectExpr("key", "id", "label", "of.size", "least", f"CAST(least div {PARTS} AS INT) AS step")
        cut = small(keep(large.select("id", "step").distinct()), broadcast_rows)
        texts = described.select("id", F.col("of.line").alias("line")).join(cut, "id")
        # at least as long as the first segment of a line of any size that has this step
        begin = f"left(line, CAST(({PARTS} * step + {last}) div ({allowed_sql(f'({PARTS} * step)', steps)} + 1) AS INT)) AS begin"
        told = cut_words(texts).join(texts.selectExpr("id", "step", begin), ["id", "step"])
        of = F.struct("size", "begin", "words").alias("of")
        large = keep(large.join(told, ["id", "step"]).select("key", "id", "label", "least", of))
        return [
            (small_ones.where("of.size = least"), small_ones, lambda x, y: ordered(x, y) & near(x, y)),
            (large.where("of.size = least"), large, lambda x, y: ordered(x, y) & parted(x, y)),
        ]

    def ordered(x: str, y: str) -> Column:
        return F.expr(f"({y}.size > {x}.size OR a < b)")

    def parted(x: str, y: str) -> Column:
        k, apart = allowed_sql(f"{y}.size", steps), f"({y}.size - {x}.size)"
        cuts = " AND ".join(
            f"bit_count({x}.words[{i}] ^ {y}.words[{i}]) + bit_count({x}.words[{i + 1}] ^ {y}.words[{i + 1}]) <= 2 * {k} + {apart}"
            for i in range(0, 2 * last, 2)
        )
        return F.expr(f"{apart} <= {k} AND (k_a & {_OF_FIRST} <> 0 OR {x}.begin <> {y}.begin) AND {cuts}")

    return sides


def removals(docs: DataFrame, max_edits: int | None = None, min_chars: int = MIN_CHARS,
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_hash, place, line_hash, first_doc_id) of every line that is alike to an earlier one.

    ``max_edits`` sets one number of edits for lines of all lengths, instead of one that grows with them.
    """
    steps = classes(max_edits, min_chars)
    found = lines(docs, min_chars)
    known = keep(
        found.select("id", F.struct("doc_id", "text_hash", "place").alias("at"), "line")
        .groupBy("id").agg(F.min("at").alias("first"), F.count("at").alias("n"), F.min("line").alias("line"))
        .withColumn("second", F.xxhash64(F.lit("second"), "line"))
    )
    members = buckets(known, steps, broadcast_rows)

    def describe(ids: DataFrame) -> DataFrame:
        texts = known.select("id", "line").join(small(keep(ids), broadcast_rows), "id", "left_semi")
        return texts.select("id", "line", F.length("line").alias("size"), *letter_counts())

    def near(x: str, y: str) -> Column:
        k = allowed_sql(f"greatest({x}.size, {y}.size)", steps)
        apart = " + ".join(f"abs({x}.c{i} - {y}.c{i})" for i in range(len(LETTERS)))
        return F.expr(f"abs({x}.size - {y}.size) <= {k} AND {apart} <= 2 * {k}")

    def verify(pairs: DataFrame) -> DataFrame:
        k = allowed_sql("greatest(of_a.size, of_b.size)", steps)
        aligned = " ".join(f"WHEN {n} THEN {alike('of_a.line', 'of_b.line', n)}" for _, n in steps)
        return pairs.where(F.expr(f"CASE {k} {aligned} END"))

    labels = link(members, describe, near, verify, narrow(near, steps, broadcast_rows))
    of = known.select("id", "second", "first", "n")
    linked = keep(labels.join(of, "id"))
    heads = linked.groupBy("label").agg(F.min("first").alias("head"))
    stays = linked.join(heads, "label").select("id", "second", "head").unionByName(
        of.where("n > 1").join(labels.select("id"), "id", "left_anti").select("id", "second", F.col("first").alias("head"))
    )
    stays = small(keep(stays), broadcast_rows // 4)
    at = found.select("doc_id", "text_hash", "place", "id", F.xxhash64(F.lit("second"), "line").alias("line_hash"))
    return at.join(stays, (at.id == stays.id) & (at.line_hash == stays.second)).where(
        ~F.struct("doc_id", "text_hash", "place").eqNullSafe(F.col("head"))
    ).select("doc_id", "text_hash", "place", "line_hash", F.col("head.doc_id").alias("first_doc_id"))


def dedup(docs: DataFrame, max_edits: int | None = None, min_chars: int = MIN_CHARS,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with n_removed (long), without the lines that are alike to earlier ones."""
    gone = keep(
        removals(docs, max_edits, min_chars, broadcast_rows).groupBy("doc_id", "text_hash")
        .agg(F.collect_set("place").alias("_gone"))
    )
    # places count for the bound, not rows, as a row holds as many as its document has lines
    total = gone.agg(F.sum(F.size("_gone"))).first()[0] or 0
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_gone")
    gone = F.broadcast(gone) if total <= broadcast_rows else gone
    kept = (
        "array_join(transform(array(split(text, '\\n')), l -> array_join(transform("
        "array_except(sequence(0, size(l) - 1), _gone), i -> l[i]), '\\n')), '')"
    )
    docs = docs.drop("n_removed")
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.expr(kept))
    count = F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length(text)) if "n_chars" in docs.columns else None
    return joined.select(
        *[text.alias(c) if c == "text" else count.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
          for c in docs.columns],
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that it keeps."""
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")
