import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import line_dedup

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def run(spark, rows):
    df = spark.createDataFrame([(*r, 9, "k") for r in rows], "doc_id long, text string, pos int, key string")
    out = line_dedup.drop_recurring_lines(df)
    assert out.columns == ["doc_id", "text", "pos", "key", "n_lines", "n_dropped"]
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()}


def test_templates(spark):
    rows = [(1, f"own first line of one\n{LONG}"), (2, f"{LONG}\n\nown line of two"),
            (3, LONG.replace("theta", "changed")), (4, "alpha beta gamma " + "other words that are quite unlike it here now"),
            (5, f"{LONG}\n{LONG}"), (6, None), (7, ""), (8, "\n \n"),
            (9, "Page 12 of the report number 7 from 2020-01-02 by user 55 at night"),
            (10, "Page 3 of the report number 19 from 2021-11-12 by user 7 at night")]
    rows += [(100 + i, f"All rights reserved.\nbody {'x' * i} y") for i in range(10)]
    rows += [(200 + i, f"Seen nine times\nother {'z' * i} w") for i in range(9)]
    got = run(spark, rows)
    assert got[1] == (f"own first line of one\n{LONG}", 2, 0)
    assert got[2] == ("\nown line of two", 2, 1)
    assert got[3] == ("", 1, 1) and got[5] == ("", 2, 2)
    assert got[4][2] == 0
    assert got[6] == (None, 0, 0) and got[7] == ("", 0, 0) and got[8] == ("\n \n", 0, 0)
    assert got[9][2] == 0 and got[10] == ("", 1, 1)
    assert [got[100 + i][2] for i in range(10)] == [0] + [1] * 9
    assert all(got[200 + i][2] == 0 for i in range(9))


def test_repeats_long_texts_and_empty(spark):
    long_line = " ".join(f"w{chr(97 + i % 26)}{'q' * (i % 7)}" for i in range(20000))
    got = run(spark, [(1, long_line), (2, long_line + "\nmore"), (3, "a b c\n" * 5000), (None, "x y z")])
    assert got[1][2] == 0 and got[2] == ("more", 2, 1)
    assert got[3][2] == 0  # within one document only
    df = spark.createDataFrame([(1, LONG), (1, LONG)], "doc_id long, text string")
    assert [r["n_dropped"] for r in line_dedup.drop_recurring_lines(df).collect()] == [0, 0]
    assert line_dedup.drop_recurring_lines(df.limit(0)).count() == 0


A = "Alice has sent the {} parcel to the main office of {} this very morning"
B = "Alice has sent back {} of her old books and then {} more for sale"


def prose(i):
    rng = random.Random(i)
    return "Alice has sent " + " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(11))


def test_templates_do_not_depend_on_the_other_lines_of_their_leaf(spark):
    words = ["red", "blue", "green", "white", "black"]
    rows = [(i, A.format(w, w + "town")) for i, w in enumerate(words)]
    rows += [(10 + i, B.format(w, w + "ish")) for i, w in enumerate(words)]
    assert len({len(t.split()) for _, t in rows}) == 1
    mixed = rows + [(100 + i, prose(i)) for i in range(60)]
    for table in (rows, mixed):
        got = run(spark, table)
        assert [got[i][2] for i in range(5)] == [0, 1, 1, 1, 1]
        assert [got[10 + i][2] for i in range(5)] == [0, 1, 1, 1, 1]
        assert not any(got[i][2] for i in got if i >= 100)


def test_short_templates(spark):
    names = ["ann", "bea", "cid", "dan", "eve", "fay", "gus", "hal", "ida", "jon"]
    got = run(spark, [(i, f"Filed under the heading of {x} today") for i, x in enumerate(names)]
              + [(200 + i, f"Read more\n{x}{y}") for i, (x, y) in enumerate((x, y) for x in names for y in names)]
              + [(400 + i, f"See also\n{x}{y}z") for i, (x, y) in enumerate((x, y) for x in names for y in names[1:])])
    assert [got[i][2] for i in range(10)] == [0] + [1] * 9
    assert [got[200 + i][2] for i in range(100)] == [0] + [1] * 99
    assert not any(got[400 + i][2] for i in range(90))


def test_lines_of_numbers_are_compared_as_they_are(spark):
    def row(i, n):
        return " ".join(str(1000 * i + j) for j in range(n))
    rows = [(i, f"{row(i, 12)}\n{row(i, 4)}") for i in range(12)] + [(50, row(3, 12))]
    got = run(spark, rows)
    assert all(got[i][2] == 0 for i in range(12)) and got[50] == ("", 1, 1)


def masked(line):
    tokens = line.split()
    fields = ["<*>" if re.search("[0-9]", t) else t for t in tokens]
    return tuple(fields if fields.count("<*>") <= 0.5 * len(fields) else tokens)


def instances(lines):
    """The template of ``lines`` (tokens -> times) and its instances."""
    template = []
    for place in zip(*[[(t, n) for t in line] for line, n in lines.items()]):
        c = Counter()
        for token, n in place:
            c[token] += n
        token, n = max(c.items(), key=lambda x: (x[1], x[0]))
        template.append(token if 2 * n > sum(c.values()) and token != "<*>" else None)
    return tuple(template), {x for x in lines if sum(a == b for a, b in zip(x, template)) >= 0.7 * len(x)}


def hashes(spark, templates):
    """Spark's hash of (leaf, template), which ties go by."""
    rows = [(leaf[0], " ".join(leaf[1]), list(t)) for leaf, t in templates]
    df = spark.createDataFrame(rows, "n int, lead string, template array<string>")
    own = F.xxhash64(F.xxhash64("n", "lead"), "template")
    return {((r["n"], tuple(r["lead"].split())), tuple(r["template"])): r["k"] for r in df.withColumn("k", own).collect()}


def brute(spark, docs):
    """Positions dropped from each document."""
    places, leaves, choices = defaultdict(list), defaultdict(Counter), defaultdict(set)
    for i, text in docs:
        for pos, line in enumerate((text or "").split("\n")):
            tokens = masked(line)
            if tokens:
                places[tokens].append((i, pos))
                if len(tokens) >= 3 and not re.search("[0-9]", " ".join(tokens)):
                    leaves[len(tokens), tokens[:3]][tokens] += 1
    template_of = {}
    for leaf, lines in leaves.items():
        if len(lines) < 2:
            continue
        _, hit = instances(lines)
        template_of.update(dict.fromkeys(hit, leaf))
        rest = {x: n for x, n in lines.items() if x not in hit}
        bands, m = defaultdict(set), leaf[0] - 3
        for x in rest:
            size = min(math.floor(0.3 * leaf[0] + 1e-9) + 1, m)
            for b in range(size):
                bands[b, x[3 + b * m // size:3 + (b + 1) * m // size]].add(x)
        groups = {frozenset(g) for g in bands.values() if len(g) > 1}
        for g in groups:
            template, hit = instances({x: rest[x] for x in g})
            for x in hit:
                choices[x].add((sum(rest[y] for y in hit), leaf, template))
    rank = hashes(spark, {c[1:] for own in choices.values() for c in own})
    for x, own in choices.items():
        template_of[x] = max(own, key=lambda c: (c[0], rank[c[1:]]))[1:]
    of = defaultdict(list)
    for tokens, at in places.items():
        of[template_of.get(tokens, tokens)] += [(len(tokens), *p) for p in at]
    dropped = defaultdict(set)
    for at in of.values():
        found, n = len({i for _, i, _ in at}), at[0][0]
        if found >= (2 if n >= 10 else 10 if n >= 3 else 100):
            for _, i, pos in sorted(at, key=lambda x: x[1:])[1:]:
                dropped[i].add(pos)
    return dropped


def check(spark, docs):
    dropped = brute(spark, docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.drop_recurring_lines(df).collect()}
    for i, text in docs:
        lines = (text or "").split("\n")
        rest = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in dropped[i])
        assert got[i] == (rest, sum(bool(x.split()) for x in lines), len(dropped[i])), i
    return sum(map(len, dropped.values()))


def test_matches_brute_force(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijk", k=rng.randint(1, 6))) for _ in range(300)]
    shapes = [[rng.choice(words) for _ in range(n)] for n in (3, 4, 5, 6, 8, 10, 12, 12, 15, 20, 30) for _ in range(3)]
    shapes += [x[:3] + rng.choices(words, k=len(x) - 3) for x in shapes]  # other templates of the same leaves
    docs = []
    for i in range(150):
        lines = []
        for _ in range(rng.randint(0, 8)):
            kind, shape = rng.random(), list(rng.choice(shapes))
            if kind < 0.6:
                for at in rng.sample(range(len(shape)), rng.randint(0, max(1, len(shape) // 4))):
                    shape[at] = rng.choice(words) if kind < 0.4 else str(rng.randint(0, 999))
                lines.append("  ".join(shape) if kind < 0.1 else " ".join(shape))
            else:
                lines.append(rng.choice(["", "Read more", "12 34 56", " ".join(rng.choices(words, k=rng.randint(1, 14)))]))
        docs.append((i, "\n".join(lines)))
    assert check(spark, docs) > 100


def test_query_matches_brute_force_on_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert check(spark, docs) > 300


def test_every_shared_band_counts(spark):
    """A template shared in its last band only, in a leaf where the first bands hold larger groups of other lines."""
    rng = random.Random(4)

    def other():
        return ["".join(rng.choices("qrstuvw", k=6)) for _ in range(40)]

    tail = [f"t{c}" for c in "abcdefghijklmnopqrstuvwxyzABC"]
    head = ["Alice", "has", "sent"]
    rows = [(i, " ".join(head + other()[:11] + tail)) for i in range(2)]
    for i in range(60):  # groups of twenty in each of the first bands, of lines that have nothing else in common
        line = other()
        fixed = 3 * (i // 20)
        line[fixed:fixed + 3] = [f"common{chr(97 + i // 20)}{k}x".replace("0", "o").replace("1", "l").replace("2", "z") for k in range(3)]
        rows.append((100 + i, " ".join(head + line)))
    got = run(spark, rows)
    assert [got[i][2] for i in range(2)] == [0, 1] and not any(got[i][2] for i in got if i >= 100)
