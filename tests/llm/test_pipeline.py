"""The pipeline's stages, each judged on its own input, and run() against a brute-force version of all of them."""

import collections
import re

import corpus_pipeline
from tests.llm.test_on_tables import shingles
from tests.llm.test_operators import SCHEMA, corpus, words
from tidemark.llm import lines, neardup, quality

SPLIT = r"[ \t\x0b\f\r]+"


def corpus_of(spark, path):
    rows = corpus(2, 80)
    stop = "the of and to in is it for on that the of and "
    rows = [(d, stop + t if t and len(t) < 10_000 else t, *rest) for d, t, *rest in rows if d is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, corpus(2, 80)[7][1])], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows


def test_stages(spark, tmp_path):
    corpus_of(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs)
    assert all(d.columns == corpus_pipeline.COLUMNS for d in seen[:4])
    kept = seen[2].collect()
    groups = collections.Counter(r.component_id for r in neardup.labelled(seen[2]).collect())
    assert max(groups.values()) == 1 and kept
    assert seen[1].count() == seen[0].count() - lines.deduped(seen[0]).filter("n_lines > 0 and n_lines = n_dropped").count()
    assert 7 not in {r.doc_id for r in seen[3].collect()}
    assert {r.doc_id for r in seen[4].collect()} == {r.doc_id for r in seen[3].collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen[4].count()


def kept_by_rules(text):
    w = [x.decode() for x in words(text)]
    seen = collections.defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    if len(w) < 20 or 100 * len(repeated) > 30 * len(w):
        return False
    ls, stops = [x for x in text.split("\n") if x.split()], {x for ws in quality.STOP_WORDS.values() for x in ws}
    chars, symbols, dup, stop = sum(map(len, w)) / len(w), sum(text.count(c) for c in quality.SYMBOLS) / len(w), (len(ls) - len(set(ls))) / len(ls), sum(x in stops for x in w) / len(w)
    return 1.5 <= chars <= 20 and symbols <= 0.1 and dup <= 0.5 and stop >= 0.02


def without_lines(rows):
    """Texts without lines that recur as they stand, or whose templates do; templates as far as single lines tell, as no leaf here has more than four values."""
    where, template, parsed = collections.defaultdict(set), collections.defaultdict(set), []
    for k, (d, text) in enumerate(rows):
        for pos, line in enumerate(text.split("\n")):
            w = [x for x in re.split(SPLIT, line) if x]
            if w:
                masked = ["<*>" if re.search("[0-9]", x) else x for x in w]
                key = ("m", *masked) if 10 * (len(masked) - masked.count("<*>")) >= 6 * len(w) else ("r", *w)
                parsed.append((k, d, pos, line, key, len(w)))
                template[key].add(d)
                where[line].add(d)
    gone = collections.defaultdict(set)
    for k, d, pos, line, key, n in parsed:
        if (len(template[key]) >= 8 and d > min(template[key])) or (n >= 5 and d > min(where[line])):
            gone[k].add(pos)
    out, counted = [], collections.Counter(k for k, *_ in parsed)
    for k, (d, text) in enumerate(rows):
        if not counted[k] or counted[k] > len(gone[k]):
            out.append((d, "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[k])))
    return out


def test_run_against_brute_force(spark, tmp_path):
    rows = corpus_of(spark, tmp_path)
    bench = [c for c in re.split(r"[^0-9a-z\x80-\U0010ffff]+", corpus(2, 80)[7][1].lower()) if c]
    kept = without_lines([(d, t) for d, t, *_ in rows if t is not None and kept_by_rules(t)])
    sets, root = [shingles(t) for _, t in kept], list(range(len(kept)))

    def top(x):
        return x if root[x] == x else top(root[x])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[top(i)] = top(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(kept):
        least[top(i)].append(d)
    unique = [(d, t) for i, (d, t) in enumerate(kept) if d == min(least[top(i)])]
    windows = {tuple(bench[i : i + 13]) for i in range(len(bench) - 12)}

    def clean(text):
        w = [c for c in re.split(r"[^0-9a-z\x80-\U0010ffff]+", text.lower()) if c]
        hit = {i + k for i in range(len(w) - 12) if tuple(w[i : i + 13]) in windows for k in range(13)}
        return not hit or 20 * len(hit) < len(w)

    want = collections.Counter(d for d, t in unique if clean(t))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter(r.doc_id for r in got if r.piece == 0) == want and 10 < len(want) < 70
    ends = collections.defaultdict(int)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048
