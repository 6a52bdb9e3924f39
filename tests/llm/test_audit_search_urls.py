"""Filter audit, ranked search and URL verdicts against brute-force versions on small awkward frames."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.llm import geometric_blocks as G
from loam.llm.filter_audit import audit_orders, filter_audit, mask_cells
from loam.llm.shipping import ship_package
from loam.llm.url_boosting import Rule, fit_url_model, fitting_rule, host_and_path, url_verdicts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(G.TERM_PATTERN)
# extra columns whose names the operators use inside
DOCS = "doc_id long, source string, text string, part string, mask int, n long, ids string, score string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def documents():
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdeéB中") for _ in range(rng.randint(1, 5))) for _ in range(80)]
    prose = lambda n, words=vocab: " ".join(rng.choice(words) for _ in range(n))
    copy = prose(70)
    rows = [(0, "a", prose(60)), (1, None, None), (2, "", ""), (3, "a", "  \n\t"), (4, "b", "one"), (5, "b", "A # B"),
            (6, "a", prose(400, vocab[:9])), (7, "b", "LOUD " * 60), (None, "a", copy), (None, None, None), (9, "a", prose(9000))]
    rows += [(10 + i, "ab"[i % 2], copy) for i in range(40)]                 # a third of the rows are copies
    rows += [(60 + i, "b", prose(rng.randint(40, 120)) + " &" * (i % 2)) for i in range(30)]
    rows += [(10, "b", copy), (60, "b", "another text of sixty"), (10, "b", copy)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, "i", "s") for r in rows], DOCS)


LABELS = [(0, 1, 0), (6, 0, 1), (7, None, 1), (10, 1, 1), (10, 0, None), (12, 1, 0), (None, 1, 1), (999, 1, 1), (60, None, None)]


def audited(rows, labels):
    """Filter by filter, document by document."""
    def fails(i, text):
        words = WORD.findall(text)
        smaller = i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in rows)
        return [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                bool(re.search(r"[#$%&*|]", text)), smaller]

    docs = [(s or "", fails(i, t or ""), any(j == i and q == 1 for j, q, _ in labels if i is not None),
             any(j == i and x == 1 for j, _, x in labels if i is not None)) for i, s, t in rows]
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in itertools.permutations(range(5)):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                own = [d for d in docs if d[0] == part and d[1][f]]
                shapley[part, f] += len(gone)
                out[part, "".join("ABCDE"[i] for i in order), step + 1] = [
                    len(left), len(gone), len(own) - len(gone), sum(sum(d[1]) == 1 for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone), f]
    return {k: (*v[:-1], shapley[k[0], v[-1]]) for k, v in out.items()}


def test_audit_equals_filtering_in_every_order(spark):
    rows = documents()
    got = filter_audit(frame(spark, rows), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()}
    assert got == audited(rows, LABELS)


def test_audit_of_nothing_and_of_other_letters(spark):
    none = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(none, labels).count() == 0
    masks = spark.createDataFrame([(1, "x", 3), (2, "x", 2), (3, "x", 0)], "doc_id long, part string, mask int")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley)
           for r in audit_orders(mask_cells(masks, labels), "PQ").collect()}
    assert got == {("PQ", 1): (2, 1, 0, 0, 1), ("PQ", 2): (1, 1, 1, 1, 3), ("QP", 1): (1, 2, 0, 1, 3), ("QP", 2): (1, 0, 1, 0, 1)}
    with pytest.raises(ValueError):
        audit_orders(mask_cells(masks, labels), "AAB")


def low(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(rows, items, k=10):
    """Every document scored for every item."""
    docs = [(i, Counter(low(t))) for i, _, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total, df = len(docs), sum(d[2] for d in docs), Counter(t for d in docs for t in d[1])
    out = []
    for item in {i for i, _ in items}:
        terms = {t for i, text in items if i == item for t in low(text)}
        scores = []
        for i, c, size in docs:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def items_of(rows):
    texts = [t for _, _, t in rows if t and t.split()]
    return [(0, " ".join(texts[0].split()[:12])), (1, texts[-4]), (2, None), (3, "no-such unknownterm"), (4, "ONE # two"), (None, "one"),
            (5, " ".join(t.split()[0] for t in texts[:20])), (5, "one"), (6, texts[6][:40]), (7, texts[4])]


@pytest.mark.parametrize("postings,block", [(400_000, 16), (300, 2)])
def test_search_equals_scoring_all(spark, monkeypatch, postings, block):
    for name, value in (("SHARD_POSTINGS", postings), ("BLOCK_DOCS", block)):
        monkeypatch.setattr(G, name, value)
    rows = documents()
    items = items_of(rows)
    got = G.rank_documents(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(rows, items)


def test_search_in_several_runs_and_over_nothing(spark, monkeypatch):
    monkeypatch.setattr(G, "BLOCK_PAIRS", 40)
    rows = documents()
    items = spark.createDataFrame(items_of(rows), "item_id long, text string")
    got = G.rank_documents(frame(spark, rows), items, k=3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(rows, items_of(rows), 3)
    assert G.rank_documents(frame(spark, []), items).count() == 0
    assert G.rank_documents(frame(spark, rows), items.limit(0)).count() == 0


def test_blocks_are_skipped_only_below_the_threshold():
    """Bounds hold for every document of a block, and a high threshold skips most blocks."""
    rng = np.random.default_rng(0)
    terms = 60
    rows = [np.unique(rng.integers(0, terms, 12) if d % 9 else rng.integers(0, 6, 5)) for d in range(600)]
    ptr = np.r_[0, np.cumsum([r.size for r in rows])]
    ids = np.concatenate(rows)
    tf = rng.integers(1, 9, ids.size)
    queries = G.Queries([0], [np.arange(terms, dtype=np.uint64)])
    queries.weigh(600, int(tf.sum()), np.bincount(ids, minlength=terms))
    shard = G.Shard(np.arange(600), np.zeros(600, bool), np.add.reduceat(tf, ptr[:-1]), ptr, ids, tf, queries)
    asked = np.array([1, 2, 7, 30, 41])
    every, score = shard.best(asked, np.arange(600), 1, 600)
    least = int(score[9])
    needed = shard.needed(asked, least)
    shard.cluster(np.arange(terms))
    docs = shard.unskipped(asked, needed, least)
    assert set(every[score >= least]) <= set(docs)
    assert docs.size < shard.holding(needed).size
    for b in range(shard.member_at.size - 1):
        most = dict(zip(shard.summary_terms[shard.summary_at[b]:shard.summary_at[b + 1]].tolist(),
                        shard.summary_most[shard.summary_at[b]:shard.summary_at[b + 1]].tolist(), strict=True))
        for d in shard.members[shard.member_at[b]:shard.member_at[b + 1]]:
            assert all(most[t] >= w for t, w in zip(ids[ptr[d]:ptr[d + 1]].tolist(), shard.weight[ptr[d]:ptr[d + 1]].tolist(), strict=True))


URLS = ["http://a.example.net/en/1", "https://Example.NET/de/?q=/en/", "ftp://x.org/fr/a", "http://org/fr/", "http://org/fr", "http://net", "http://net/",
        "http://notnet/", "http://b.net?x=1", "http://www.example.com/de/1#top", "http://www.example.com/en/1", "no scheme", "", None, "://", "x://h://y/z",
        "http://ÉXAMPLE.org/fr/é?ü", "http://h/" + "a/" * 5000 + "?" + "p=1&" * 900, "http://a.example.net/en/1"]
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in url_verdicts(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts(url)
        fits = [(len(h + p), h + p, v) for (h, p), v in RULES.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, max(fits)[1] if fits else None), url
        assert got[i].verdict == max(fits)[2] if fits else got[i].verdict in ("allow", "block")


def test_equal_rules_and_bad_ones(spark):
    urls = spark.createDataFrame([("http://b.c/x/",), ("http://a.b.c/x/",)], "url string")
    host, path = host_and_path(F.col("url"))
    rules = [Rule("allow", "b.c", "/x/"), Rule("block", "a.b.c", "/"), Rule("block", "b.c", "/x/")]
    got = [tuple(r[0]) for r in urls.select(fitting_rule(host, path, rules)).collect()]
    assert got == [("b.c/x/", "block"), ("a.b.c/", "block")]
    with pytest.raises(ValueError):
        fitting_rule(host, path, [Rule("deny", "a")])


def test_verdicts_without_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_verdicts(none).count() == 0
    free = spark.createDataFrame([(1, "http://a.com/"), (None, None)], "page_id long, url string")
    assert {r.verdict for r in url_verdicts(free).collect()} == {"allow"}
    blocked = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.net/")], "page_id long, url string")
    assert {r.verdict for r in url_verdicts(blocked).collect()} == {"block"}


def test_trees_judge_unseen_urls(spark):
    """Held out: URLs of hosts that the training never saw, told apart by digits, hyphens and parameters."""
    rng = random.Random(1)

    def url(bad):
        name = "".join(rng.choice("abcdefghij") for _ in range(8))
        if bad:
            return f"http://{name}-{rng.randint(10**5, 10**6)}-win.com/{rng.randint(10**6, 10**7)}?a={rng.randint(1, 9)}&b=2&c=3"
        return f"http://{name}.com/{rng.choice(['news', 'about', 'team'])}/{name}"

    rows = [(url(i % 3 == 0), i % 3 == 0) for i in range(900)]
    train = spark.createDataFrame(rows[:600], "url string, blocked boolean")
    test = spark.createDataFrame(rows[600:], "url string, y boolean")
    judged = fit_url_model(train).judge(test)
    assert judged.columns == ["url", "y", "blocked"]
    assert judged.filter("y = blocked").count() >= 0.97 * 300
    small = fit_url_model(train, sample_urls=150).judge(test)          # a bounded sample serves as well
    assert small.filter("y = blocked").count() >= 0.9 * 300
