import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellframe.llm import line_dedup


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            above, row[j] = row[j], min(above + (c != d), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def changed(text: str, n: int, letters: str) -> str:
    out = list(text)
    for _ in range(n):
        kind, at = random.randrange(3), random.randrange(len(out) + 1)
        if kind == 0:
            out.insert(at, random.choice(letters))
        elif at < len(out) and kind == 1:
            del out[at]
        elif at < len(out):
            out[at] = random.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance_equals_levenshtein(spark, k):
    random.seed(k)
    rows = []
    for _ in range(1_500):
        a = "".join(random.choices("abç", k=random.randrange(1, 24)))
        rows.append(sorted((a, changed(a, random.randrange(7), "abç") or "a"), key=len, reverse=True))
    df = spark.createDataFrame(rows, "a string, b string").select(
        F.split("a", "").alias("x"), F.split("b", "").alias("y"), F.expr(f"levenshtein(a, b) <= {k}").alias("near"))
    assert df.where(F.expr(line_dedup.within("x", "y", k)) != F.col("near")).isEmpty()


@pytest.mark.parametrize("k", [1, 2])
def test_alike_equals_levenshtein(spark, k):
    random.seed(20 + k)
    rows = [("", ""), ("a", ""), ("", "ab"), ("abc", "abc"), ("aba", "a"), ("aaaa", "aa"), ("a" * 99 + "xb", "a" * 99 + "b")]
    for _ in range(800):
        a = "".join(random.choices("abç", k=random.randrange(24)))
        rows.append((a, changed(a, random.randrange(5), "abç")))
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.where(f"{line_dedup.alike('a', 'b', k)} <> (levenshtein(a, b) <= {k})").isEmpty()


@pytest.mark.parametrize("k", [1, 2])
def test_equals_brute_force(spark, k):
    random.seed(10 + k)
    base = ["".join(random.choices("abcdefgh ", k=random.randrange(12, 40))) for _ in range(25)]
    docs = []
    for i in range(60):
        picked = [changed(random.choice(base), random.choice([0, 0, 1, 2, 3]), "abcxyz") for _ in range(random.randrange(6))]
        docs.append((i, "\n".join(picked + ["short"])))
    lines = [(i, p, x) for i, t in docs for p, x in enumerate(t.split("\n")) if len(x) >= 12]
    label = list(range(len(lines)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(lines)):
        for y in range(x):
            if abs(len(lines[x][2]) - len(lines[y][2])) <= k and edits(lines[x][2], lines[y][2]) <= k:
                a, b = sorted((root(x), root(y)))
                label[b] = a
    gone = {lines[x][:2] for x in range(len(lines)) if root(x) != x}
    want = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup(df, k, 12).collect()}
    assert got == want
    assert {r.doc_id: r.text for r in line_dedup.dedup(df, k, 12, broadcast_rows=0).collect()} == want


def test_a_hub_does_not_hide_links(spark):
    """Variants of one line that are not alike among themselves: the base links all of them."""
    base = "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz"
    rows = [(i, base[:i] + "#" + base[i + 1:]) for i in range(len(base))] + [(99, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in line_dedup.dedup(df).where("n_removed = 0").collect()]
    assert kept == [0]


def test_odd_rows(odd_docs, no_docs):
    out = line_dedup.dedup(odd_docs)
    assert out.columns == odd_docs.columns + ["n_removed"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append((r.text, r.n_removed, r.n_chars))
    assert got[1][0][1] == 0 and got[2] == [("", 2, 0)]
    assert got[5] == [(None, 0, 0)] and got[7] == [("one", 0, 3)] * 2 and got[4] == [("", 0, 0)]
    assert len(got[9][0][0]) == 150_000 and got[None][0][1] == 0
    assert line_dedup.dedup(no_docs).isEmpty()
    with pytest.raises(ValueError):
        line_dedup.dedup(odd_docs, 3, 6)


def test_allowed_edits_grow_with_the_line(spark):
    """Lines of every class of lengths, evenly spread edits: as many as are allowed, and one more."""
    random.seed(7)
    docs, want = [], {}
    for n in (30, 39, 60, 79, 80, 81, 83, 119, 159, 160, 162, 240, 319, 320, 323, 324, 500, 1_100, 2_500):
        for more in (0, 1):
            for edit in ("#", ""):  # characters replaced, or left out
                k = line_dedup.allowed(n) + more
                line = "".join(random.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
                spots = {(2 * i + 1) * n // (2 * k) for i in range(k)}
                other = "".join(edit if i in spots else c for i, c in enumerate(line))
                if len(other) >= line_dedup.MIN_CHARS:
                    want[len(docs) + 1] = int(not more)
                    docs += [(len(docs), line), (len(docs) + 1, other)]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: want.get(i, 0) for i in range(len(docs))}


def registered(docs):
    """The registered operator by comparing all pairs of lines, as {doc_id: text}."""
    lines = sorted({x for _, t in docs for x in t.split("\n") if len(x) >= line_dedup.MIN_CHARS})
    label = list(range(len(lines)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x, one in enumerate(lines):
        for y in range(x):
            k = line_dedup.allowed(max(len(one), len(lines[y])))
            if abs(len(one) - len(lines[y])) <= k and edits(one, lines[y]) <= k:
                a, b = sorted((root(x), root(y)))
                label[b] = a
    group = {line: root(i) for i, line in enumerate(lines)}
    seen, want = set(), {}
    for i, t in docs:
        left = []
        for x in t.split("\n"):
            if x not in group or group[x] not in seen:
                left.append(x)
            if x in group:
                seen.add(group[x])
        want[i] = "\n".join(left)
    return want


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_registered_operator_equals_brute_force(spark, broadcast_rows):
    """Lines around every bound of lengths, with about as many edits as are allowed, also where lengths straddle a bound."""
    random.seed(31)
    docs = []
    for n in (29, 30, 31, 78, 80, 82, 157, 160, 163, 316, 320, 324):
        for _ in range(3):
            base = "".join(random.choices("abcdefgh ", k=n))
            docs += [(len(docs) + i, changed(base, random.randrange(6), "abcxyz")) for i in range(4)]
    docs = [(i, t + "\n" + random.choice(docs)[1]) for i, t in docs]
    got = line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string"), broadcast_rows=broadcast_rows)
    want = registered(docs)
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert 40 < sum(want[i] != t for i, t in docs) < len(docs)


def test_windows_are_as_small_as_they_can_be():
    for k in range(1, 6):
        for shorter in range(k + 1):
            assert sum(d == shorter for _, d, _ in line_dedup.windows(k)) == (k * k - shorter * shorter) // 2 + k + 1


@pytest.mark.parametrize("steps", [line_dedup.CLASSES, ((12, 2),)])
def test_windows_of_a_size_are_one_constant_list(spark, steps):
    """Those of every class that the size falls into, and nothing is evaluated for each line to find them."""
    as_index, as_probe = (line_dedup.index_windows, True), (line_dedup.probe_windows, False)
    windows = line_dedup._by_size(steps, as_index, as_probe)
    sizes = sorted({max(start + d, 0) for start, _ in steps for d in range(-6, 7)} | {5_000})
    rows = spark.createDataFrame([(n,) for n in sizes], "size int").selectExpr("size", f"inline_outer({windows})")
    got = defaultdict(list)
    for r in rows.where("k IS NOT NULL").collect():
        got[r.size].append((r.k, r.segment, r.shorter, r.shift))
    for n in sizes:
        want = []
        for (start, k), end in zip(steps, [*(start for start, _ in steps[1:]), 10**9]):
            want += line_dedup.index_windows(k) if start - k <= n < end else []
            want += line_dedup.probe_windows(k) if start <= n < end else []
        assert sorted(got[n]) == sorted(want)
    lines = spark.createDataFrame([(1, "x" * 100)], "id long, line string")
    plan = line_dedup.keys(lines, windows)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "concat" not in plan


def test_near_copies_apart_are_not_paired(spark, monkeypatch):
    """Lines that part from one line at different places, beyond the allowed edits and with equal letters in all."""
    random.seed(5)
    words = ["".join(random.sample("abcdefgh", 8)) for _ in range(40)]
    docs = [(99, " ".join(words))]
    for i in range(40):
        other = "".join(random.sample("stuvmnop", 8))
        docs.append((100 + i, " ".join([*words[:i], other, *words[i + 1:]])))
        if i % 8 == 0:  # a copy of it, one letter apart, that the base does not link
            docs.append((200 + i, " ".join([*words[:i], other[:3] + "z" + other[4:], *words[i + 1:]])))
    verified, link = [], line_dedup.link

    def counted(members, describe, near, verify, *more):
        def counting(pairs):
            verified.append(pairs.select("a", "b").distinct().count())
            return verify(pairs)

        return link(members, describe, near, counting, *more)

    monkeypatch.setattr(line_dedup, "link", counted)
    got = {r.doc_id for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert got == {200 + i for i in range(0, 40, 8)}
    assert verified[1] < 150  # of 1,035


@pytest.mark.parametrize("steps", [line_dedup.CLASSES, ((12, 2),)])
def test_no_alike_pair_is_narrowed_away(spark, steps):
    """Pairs of lines as far apart as is allowed, of like and unlike sizes, around every bound of lengths."""
    random.seed(17)
    lines = []
    for n in (12, 15, 16, 17, 31, 47, 79, 80, 81, 100, 159, 160, 162, 318, 320, 323, 700):
        for _ in range(4 if n >= steps[0][0] else 0):
            base = "".join(random.choices("abcdetx,ç ", k=n))
            k = line_dedup.allowed(n, steps)
            copies = [changed(base, random.choice([1, k, k + 1]), "abcdetx,ç ") for _ in range(5)]
            lines += [x for x in {base, *copies, base[1:] + "a", "b" + base[:-1]} if len(x) >= steps[0][0]]
    known = spark.createDataFrame(list(enumerate(lines)), "id long, line string").cache()
    windows = line_dedup._by_size(steps, (line_dedup.index_windows, True), (line_dedup.probe_windows, False))
    described = known.select("id", F.struct("line", F.length("line").alias("size")).alias("of"))
    rest = line_dedup.keys(known, windows).join(described, "id").withColumn("label", F.col("id"))
    for broadcast_rows, few in ((1_000_000, 0), (0, 8)):
        got = set()
        for one, two, holds in line_dedup.narrow(lambda x, y: F.lit(True), steps, broadcast_rows, few)(rest, described):
            one, two = (
                side.select(F.col("key").alias(f"k_{end}"), F.col("id").alias(end), F.col("of").alias(f"of_{end}"))
                for side, end in ((one, "a"), (two, "b"))
            )
            met = one.join(two, F.expr("k_a = k_b AND a <> b") & holds("of_a", "of_b"))
            got |= {(min(r.a, r.b), max(r.a, r.b)) for r in met.select("a", "b").distinct().collect()}
        k = line_dedup.allowed_sql("greatest(length(x.line), length(y.line))", steps)
        alike = known.alias("x").join(known.alias("y"), F.expr(f"x.id < y.id AND levenshtein(x.line, y.line) <= {k}"))
        want = {(r.a, r.b) for r in alike.selectExpr("x.id AS a", "y.id AS b").collect()}
        assert len(want) > 100 and want <= got
