import random
import re
from collections import defaultdict

import numpy as np
import pytest

from adspark.llm import neardup

from .helpers import AWKWARD, docs


def shingle_set(words):
    return {tuple(words)} if len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows, threshold=0.8):
    """``(doc_id, class_id, copy_id, n_links, n_texts)`` of every row, by comparing all texts."""
    texts = defaultdict(list)
    for n, (doc, text) in enumerate(rows):
        words = tuple(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        texts[words or ("", n)].append((n, doc))
    keys = [k for k in texts if k[0] != ""]
    sets = {k: shingle_set(k) for k in keys}
    by_shingle = defaultdict(set)
    for k in keys:
        for s in sets[k]:
            by_shingle[s].add(k)
    links = {k: set() for k in keys}
    for k in keys:
        counts = defaultdict(int)
        for s in sets[k]:
            for o in by_shingle[s]:
                counts[o] += 1
        links[k] = {o for o, c in counts.items() if o != k and 5 * c >= 4 * (len(sets[k]) + len(sets[o]) - c)}
    out, done = [None] * len(rows), set()
    least = lambda ids: min([i for i in ids if i is not None], default=None)
    for k in texts:
        if k in done:
            continue
        group, todo = set(), [k]
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += links.get(x, ())
        done |= group
        cls = least(d for x in group for _, d in texts[x])
        for x in group:
            for n, doc in texts[x]:
                near = links.get(x, ())
                out[n] = (doc, cls, least(d for _, d in texts[x]), len(texts[x]) - 1 + sum(len(texts[o]) for o in near), len(near))
    return out


def corpus(seed=1, groups=25, size=12):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(groups):
        base = [r.choice(vocab) for _ in range(r.choice([6, 30, 120, 400]))]
        for _ in range(r.randint(1, size)):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, len(base) // 40])):
                words[r.randrange(len(words))] = r.choice(vocab)
            rows.append((n, r.choice([" ", "\n", "  "]).join(words)))
            n += 1
    return rows


def compare(spark, rows, **kw):
    got = neardup.near_duplicates(docs(spark, rows), **kw).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)
    return got


def test_incidence_counts_intersections(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    r = random.Random(2)
    sets = [set(r.sample(range(60), r.randint(1, 40))) for _ in range(20)]
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    got = neardup._incidence(arrays[:12], arrays[8:])
    assert got.tolist() == [[len(a & b) for b in sets[8:]] for a in sets[:12]]


def test_signature_estimates_similarity():
    r = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.95):
        same = []
        for _ in range(30):
            pool = r.integers(0, 2**63, 1000, dtype=np.uint64)
            k = int(1000 * share)
            a, b = pool[:k + (1000 - k) // 2], np.concatenate([pool[:k], pool[k + (1000 - k) // 2:]])
            same.append((neardup.signature(a) == neardup.signature(b)).mean())
        assert abs(np.mean(same) - share) < 0.03


def test_against_brute_force(spark):
    rows = corpus() + [(10_000 + i, t) for i, (_, t) in enumerate(corpus(1)[:40])] + [r[:2] for r in AWKWARD]
    got = compare(spark, rows)
    assert sum(r["n_texts"] > 0 for r in got) > 50


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 5)
    compare(spark, corpus(7, groups=4, size=40))


def chains(n, length=6, words=80, step=5, seed=11):
    """Texts that are linked with the next of their chain alone; their keys' order is random."""
    r = random.Random(seed)
    rows = []
    for c in range(n):
        line = [f"c{c}x{r.randrange(10**9)}" for _ in range(words + step * (length - 1))]
        rows += [" ".join(line[step * k:step * k + words]) for k in range(length)]
    return rows


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_block_pairs_keep_chains_whole(blocks):
    r = random.Random(blocks)
    texts = chains(1)
    for _ in range(60):
        keys = r.sample(range(256), len(texts))
        rows = [{"key": bytes([k]), "copies": 1, "words": t, "at": r.randrange(blocks)} for k, t in zip(keys, texts)]
        class_of, n_texts = {x["key"]: x["key"] for x in rows}, defaultdict(int)
        for low in range(blocks):
            for high in range(low, blocks):
                run = [{**x, "low": low, "high": high, "side": x["at"] == high != low} for x in rows if x["at"] in (low, high)]
                for key, _, n, root in neardup._linked(run, 0.8) if run else ():
                    n_texts[key] += n
                    old, new = class_of[key], class_of[root]
                    class_of = {k: new if c == old else c for k, c in class_of.items()}
        assert len(set(class_of.values())) == 1
        assert sorted(n_texts.values()) == [1, 1] + [2] * (len(texts) - 2)


@pytest.mark.parametrize("block_texts", [2048, 2])
def test_chains_stay_one_class(spark, monkeypatch, block_texts):
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", block_texts)
    texts = chains(40)
    got = compare(spark, list(enumerate(texts)))
    assert len({r["class_id"] for r in got}) == 40


def test_recall_on_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted(brute([(r["doc_id"], r["text"]) for r in table.collect()]), key=repr)
    assert sorted(map(tuple, neardup.near_duplicates(table).collect()), key=repr) == want


def test_one_of_each_stays(spark):
    awkward = [(r[0] and r[0] + 100_000, r[1]) for r in AWKWARD]
    rows = corpus(4) + awkward + [corpus(4)[3]] * 3 + [(None, corpus(4)[5][1])]
    table = docs(spark, rows)
    out = neardup.keep_one_of_each(table)
    assert out.columns == table.columns
    wordless = [r for r in rows if not (r[1] or "").split()]
    stay = {r for r, (doc, cls, *_) in zip(rows, brute(rows)) if (r[1] or "").split() and doc == cls}
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted([*wordless, *stay], key=repr)
    assert (None, "null id text") in stay and (None, corpus(4)[5][1]) not in stay


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b")], [(1, "a b c d e f g")] * 4])
def test_small_tables(spark, rows):
    compare(spark, rows)
    assert neardup.keep_one_of_each(docs(spark, rows)).count() == min(1, len(rows))
