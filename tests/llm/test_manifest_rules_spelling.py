"""The Merkle manifest, the quality rules and the spelling variants against plain versions of themselves."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartorio.llm import merkle, quality_rules, spelling
from tests.llm.test_small import SCHEMA, corpus, frame  # noqa: F401


# Merkle manifest

def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, siblings of each leaf as (is left, digest) or None)."""
    nodes, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            paths[i].append(((a ^ 1) < a, nodes[a ^ 1]) if a ^ 1 < len(nodes) else None)
        at = [a // 2 for a in at]
        nodes = [sha(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
    return nodes[0], paths


def plain_audit(rows):
    """Of rows (doc_id, source, lang, n_chars, text): what the digest query returns, sorted."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for t in names:
        trees[t].sort(key=lambda x: x[:3])
        built[t] = plain_tree([x[2] for x in trees[t]])
    if not names:
        return []
    root, above = plain_tree([built[t][0] for t in names])
    out = []
    for k, t in enumerate(names):
        for (_, _, leaf, r), own in zip(trees[t], built[t][1]):
            path, h = own + above[k], leaf
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                h = plain_leaf((*r[:3], r[3] + 1, r[4]))
            for s in path:
                h = sha(h) if s is None else sha(s[1], h) if s[0] else sha(h, s[1])
            out.append((r[0], leaf, built[t][0], root, sha(*(s[1] for s in path if s)), h, h == root))
    return sorted(out, key=str)


def audited(df, **how):
    return sorted((tuple(r) for r in merkle.audit(df, merkle.one_more(), **how).collect()), key=str)


def documents(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, source, n) for i, source, lang, n, t in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("sizes,stride", [((1,), 4), ((2, 1), 4), ((16, 17), 4), ((37, 1, 5), 2), ((9, 70), 1)])
def test_manifest_of_trees_of_any_size(spark, sizes, stride):
    rows = [(1000 * k + i, None if i % 3 else f"s{i}", (None, "de", "é")[k], None if i % 5 == 0 else i, f"text {i}") for k, n in enumerate(sizes) for i in range(n)]
    assert audited(documents(spark, rows), stride=stride) == plain_audit(rows)


def test_manifest_of_odd_rows(spark):
    """No text, empty and very long texts, no ids, no trees, equal ids, equal rows, columns of clashing names."""
    rows = [(None, None, None, None, None), (None, "a", None, 3, ""), (7, "s", "en", 5, "x" * 300_000), (7, "s", "en", 5, "other"), (7, "s", "en", 5, "other"), (8, "s", "", 1, "é:1-")]
    df = documents(spark, rows).withColumns({"t": F.lit(1), "row": F.lit(2), "leaf": F.lit("x"), "_at": F.lit(3), "tree": F.lit(4)})
    assert audited(df) == plain_audit(rows)
    assert audited(documents(spark, []).limit(0)) == []


def test_rows_over_many_leaves_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(merkle, "MEET", 8)
    rows = [(i, "s", "en" if i % 4 else "de", i, f"t{i}") for i in range(150)]
    assert audited(documents(spark, rows), stride=2) == plain_audit(rows)
    leaves = documents(spark, rows).select(F.col("doc_id").alias("key"), F.col("lang").alias("tree"), merkle.leaf_digest(F.col("text")).alias("leaf"), F.col("doc_id").alias("row"))
    links = merkle.build(leaves, stride=2).links
    assert links.groupBy("t", "level", "idx").count().agg(F.max("count")).first()[0] == 112 // 8  # the larger tree
    monkeypatch.setattr(merkle, "FEW", 0)  # not broadcast
    assert audited(documents(spark, rows), stride=2) == plain_audit(rows)


def test_a_changed_text_is_found(spark):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(20)]
    out = merkle.audit(documents(spark, rows), {"text": F.when(F.col("doc_id") == 3, "tampered").otherwise(F.col("text"))}).collect()
    assert [r["doc_id"] for r in out if not r["verified"]] == [3]
    whole = merkle.audit(documents(spark, rows), {}, whole_proofs=True).collect()
    assert {r["doc_id"]: sha(r["proof"]) for r in whole} == {r["doc_id"]: r["proof"] for r in out} and len(whole[0]["proof"]) >= 64
    before = spark.conf.get(merkle.ROW_LIMIT)
    assert before == "1000000"  # as it was


# Quality rules

def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(hit), "n_lines": len(lines), "n_bullet_lines": sum(bool(re.match(r"[\x20\x09-\x0D]*[-*•]", x)) for x in lines),
            "n_cut_lines": sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*\Z", x)) for x in lines),
            "n_stop_words": sum(w.lower() in quality_rules.STOP_WORDS for w in words), "n_letter_words": sum(any(c.isalpha() for c in w) for w in words)}


def plain_verdict(m):
    failed = []
    for r in quality_rules.RULES:
        part, whole = 100 * m[r.part], m[r.whole]
        if m["n_words"] >= r.from_words and whole and (r.least is not None and part < r.least * whole or r.most is not None and part > r.most * whole):
            failed.append(r.name)
    base = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
    return base, failed, not base and not failed


RULE_TEXTS = [
    "a b c d e " * 8, "a b c d e f a b c d e g", "- one\n* two\n• three\n-", "this is cut...\nand this…  \nnot this", "x\n\nx\n \nx", "#hash & 50% <b> $3 | *", "12 34 ab é 56 -- ß",
    "one\x0btwo\x0cthree\rfour\x1cfive\x85six", "the " * 60, "wordwithoutanystop " * 3 + " ".join(f"w{i}x" for i in range(60)), "tie " * 4 + "a b c d e f g h", "日本語 のテスト " * 3]


def judged(df):
    return {r["doc_id"]: r["_rules"].asDict() for r in quality_rules.judge(df).collect()}


def test_rules_as_the_plain_version(spark, corpus):  # noqa: F811
    texts = [*corpus, *RULE_TEXTS, " ".join(random.Random(5).choices("abc", k=3000))]
    got = judged(frame(spark, texts))
    for i, t in enumerate(texts):
        want = plain_measures(t)
        base, failed, kept = plain_verdict(want)
        assert got[i] == want | {"base_failed": base, "failed": failed, "kept": kept}, t and t[:80]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t-#é1."), max_size=60), min_size=1, max_size=40))
def test_rules_of_any_text(spark, texts):
    got = judged(frame(spark, texts, 1))
    for i, t in enumerate(texts):
        m = plain_measures(t)
        assert {k: got[i][k] for k in m} == m and got[i]["kept"] == plain_verdict(m)[2]


def test_rules_pass_other_columns_and_take_other_tables(spark):
    df = frame(spark, ["the cat and the dog sat on a mat with us", None]).withColumns({"_rules": F.lit(1), "of": F.lit(2), "failed": F.lit(3), "row": F.lit(4)})
    out = quality_rules.judge(df, rules=())
    assert out.columns == [*df.columns, "__rules"]
    assert {r["doc_id"]: (r["_rules"], r["of"], r["failed"], r["row"], r["__rules"]["kept"]) for r in out.collect()} == {0: (1, 2, 3, 4, True), 1: (1, 2, 3, 4, False)}
    strict = quality_rules.judge(df, rules=(quality_rules.Rule("any stop word", "n_stop_words", "n_words", None, 0),))
    assert strict.filter("doc_id = 0").first()["__rules"]["failed"] == ["any stop word"]
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_rules_run_without_user_functions_and_once(spark):
    out = quality_rules.judge(frame(spark, ["a"])).filter("_rules.kept and _rules.n_words > 3 and _rules.n_lines > 1").select("doc_id", "_rules.*")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange hash", plan) and plan.count("xxhash64") == plan.split("Generate")[1].count("xxhash64") == 2  # of words and of windows


# Spelling variants

def apart(a, b):
    """Whether exactly one inserted, deleted or replaced code point makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def plain_vocabulary(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = None if i is None else zlib.crc32(f"{i}:{run}".encode())
            if h is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def plain_groups(rows):
    n = plain_vocabulary(rows)
    near = {w: [v for v in n if apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def words_near_each_other(seed, count, alphabet="abé"):
    r = random.Random(seed)
    out = set()
    while len(out) < count:
        w = "".join(r.choice(alphabet) for _ in range(r.randint(7, 10)))
        out.add(w)
        k = r.randrange(len(w))
        out.add(r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice(alphabet) + w[k:], w[:k] + r.choice(alphabet) + w[k + 1 :]]))
    return sorted(w for w in out if len(w) >= 7)


def test_lists_find_all_words_one_edit_apart():
    words = words_near_each_other(1, 400)
    own = spelling.SortedLists(words, np.zeros(len(words), np.int64))
    q, w = own.near(np.arange(len(words)))
    assert sorted(zip(q.tolist(), w.tolist())) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if apart(a, b)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab"), max_size=7), min_size=1, max_size=30, unique=True), st.integers(1, 3))
def test_any_lists(words, lists):
    key = np.sort(np.arange(len(words)) % lists)
    words = [w for k in range(lists) for w in sorted(words[i] for i in range(len(words)) if key[i] == k)]
    own = spelling.SortedLists(words, key)
    q, w = own.near(np.arange(len(words)))
    assert sorted(zip(q.tolist(), w.tolist())) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if key[i] == key[j] and apart(a, b)]


@pytest.mark.parametrize("most", [spelling.LIST, 5])
def test_near_words_whatever_the_lists_hold(spark, most, monkeypatch):
    monkeypatch.setattr(spelling, "ROWS", 200)
    words = [*words_near_each_other(2, 300), *("prefixshared" + a + b + "suffix" for a in "abcdef" for b in "abcdef"), "z" * 200, "z" * 201, "z" * 203]
    got = spelling.near_words(spark.createDataFrame([(w, 2 + k) for k, w in enumerate(words)], "word string, n long"), most).collect()
    n = {w: 2 + k for k, w in enumerate(words)}
    assert sorted(map(tuple, got)) == sorted((a, n[a], b, n[b]) for a in words for b in words if apart(a, b))


def spelling_rows():
    r = random.Random(9)
    base = words_near_each_other(4, 60, "abcdeé")
    rows = [(i, " ".join(r.choices(base, weights=[1 + 40 * (k % 9 == 0) for k in range(len(base))], k=60))) for i in range(60)]
    chain = " ".join(["chainword"] * 300 + ["chainwort"] * 25 + ["chainwart"] * 2)
    tie = " ".join(["tiewordab"] * 30 + ["tiewordac"] * 30 + ["tiewordad"] * 3)
    return [*rows, (None, base[0] + " " + base[0]), (100, None), (101, ""), (102, chain), (103, tie), (103, tie), (104, "x" * 60_000 + " " + "x" * 60_000), (105, "ABCDEFGÀ abcdefgÀ Abcdefgà abcdefgà ×÷×÷×÷×÷ short")]


def test_groups_as_the_plain_version(spark):
    rows = spelling_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit(2), "key": F.lit(3), "id": F.lit(4)}).repartition(3)
    out = spelling.group(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain_groups(rows)
    assert spelling.group(df.limit(0)).count() == 0
