import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, pos int, grp string"
COLS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in COLS)])


def climb(digest, at, nodes, proof):
    """The top of ``nodes`` with ``digest`` at ``at``; siblings go to ``proof``."""
    while len(nodes) > 1:
        run = nodes[at - at % 2:at - at % 2 + 2]
        proof.extend(x for i, x in enumerate(run) if i != at % 2)
        digest = h(*[digest if i == at % 2 else x for i, x in enumerate(run)])
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        at //= 2
    return digest


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    subroots = [climb(leaf(groups[g][0]), 0, [leaf(r) for r in groups[g]], []) for g in names]
    out = []
    for k, g in enumerate(names):
        leaves = [leaf(r) for r in groups[g]]
        for i, r in enumerate(groups[g]):
            proof = []
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            now = leaf({**r, "n_chars": r["n_chars"] + 1}) if bad else leaves[i]
            root = climb(climb(leaves[i], i, leaves, []), k, subroots, [])
            folded = climb(climb(now, i, leaves, proof), k, subroots, proof)
            out.append((r["doc_id"], leaves[i], subroots[k], root, h(*proof), folded, folded == root))
    return sorted(out, key=str)


def rows():
    rnd = random.Random(5)
    out = []
    for i in range(150):
        lang = rnd.choice(["en", "en", "en", "ü", "zz", None, ""])
        out.append(dict(doc_id=i * 3, text=rnd.choice([None, "", "a\nb", "é" * 30, "-"]), lang=lang,
                        source=rnd.choice([None, "s1"]), n_chars=rnd.choice([None, 7, 2**63 - 1]), digest="x", pos=1, grp="g"))
    out += [dict(out[5]), dict(out[5])] + [dict(out[9], source="other")]
    out += [dict(out[3], doc_id=None), dict(out[3], doc_id=None), dict(out[4], lang="lone", doc_id=-8)]
    out.append(dict(out[0], doc_id=10**6, text="long " * 200_000))
    return out


def run(spark, data, monkeypatch=None):
    from tidemark.llm import queries
    if monkeypatch:
        monkeypatch.setattr(queries, "table", lambda *a: spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in data], SCHEMA))
    return queries.op13_merkle(spark, "")


@pytest.mark.parametrize("height", [2, 12])
def test_matches_brute_force(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    data = rows()
    got = [tuple(r) for r in run(spark, data, monkeypatch).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(got, key=str) == brute(data)


def test_empty_and_single(spark, monkeypatch):
    assert run(spark, [], monkeypatch).count() == 0
    one = rows()[:1]
    r = run(spark, one, monkeypatch).first()
    assert (r["leaf"], r["subroot"], r["root"]) == (leaf(one[0]),) * 3 and r["proof_sha256"] == h()


def test_versions_copy_only_ancestors(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 67, "a").otherwise("b").alias("lang"))
    field = [F.col("doc_id")]
    changed = F.when(F.col("doc_id").isin(0, 50, 66, 99), merkle.digest([F.lit("new")]))
    m = merkle.manifest(docs, "doc_id", "lang", field, changed)
    nodes = {}
    for r in m.versions().collect():
        nodes.setdefault(r["id"], {})[r["level"]] = r["digest"]
    # 67 leaves have seven levels, 33 have six, and one joins the two groups
    assert {i: sorted(v) for i, v in nodes.items()} == {0: list(range(9)), 50: list(range(9)), 66: list(range(9)), 99: list(range(8))}
    folded = {r["id"]: (r["folded_root"], r["root"]) for r in m.proofs().collect()}
    for i, (fold, root) in folded.items():
        assert fold == (nodes[i][max(nodes[i])] if i in nodes else root) and (fold != root) == (i in nodes)
