"""The recurrent model, the url models and the token rollups."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import gru, recurrent_lm, rollups, url_ratio

SF = "/root/testdata/sf0.001"


def small_model(seed=3):
    layout = gru.Layout(np.array([0, 2, 5]), 4, 6)
    p = gru.initial(layout, np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.6, 0.4, 0.5, 0.3, 0.2]), seed)
    r = np.random.default_rng(seed)
    for name in p:
        p[name] = (p[name] + 0.3 * r.standard_normal(p[name].shape)).astype(np.float64)
    return gru.Model(layout, p)


def tokens(n=40, seed=5):
    r = np.random.default_rng(seed)
    classes = r.integers(0, 4, n)
    words = np.array([[r.integers(0, 2), r.integers(2, 5), -1, -1][c] for c in classes])
    inputs = r.integers(0, 7, n)
    lengths = np.array([13, 1, 20, 6])
    inputs[np.cumsum(lengths) - lengths] = 7
    return inputs, classes, words, lengths


def test_gradients():
    """Slopes of one window against differences of the likelihood."""
    model = small_model()
    inputs, classes, words, lengths = tokens()
    place, first = gru.lanes(lengths, 3)
    slopes = {}

    class Take:
        def step(self, p, got, n):
            slopes.update({k: v.copy() for k, v in got.items()})

    model.train(Take(), inputs, classes, words, place, first, window=len(place))
    loss = lambda: -model.score(inputs, classes, words, place, first).sum()
    r = np.random.default_rng(0)
    for name in gru.NAMES:
        flat = model.p[name].reshape(-1)
        for i in r.integers(0, flat.size, 6):
            kept, e = flat[i], 1e-2
            flat[i] = kept + e
            up = loss()
            flat[i] = kept - e
            down = loss()
            flat[i] = kept
            assert abs((up - down) / (2 * e) - slopes[name].reshape(-1)[i]) < 2e-2 * max(1, abs(slopes[name].reshape(-1)[i]))


def test_lanes_and_windows_do_not_change_scores():
    model = small_model()
    inputs, classes, words, lengths = tokens()
    whole = [model.score(inputs, classes, words, *gru.lanes(lengths, n), window=w) for n, w in ((1, 100), (4, 3), (2, 7))]
    np.testing.assert_allclose(whole[0], whole[1], atol=1e-4)
    np.testing.assert_allclose(whole[0], whole[2], atol=1e-4)


def test_lanes_hold_each_token_once_and_no_more():
    lengths = np.array([20_000, *range(1, 120), 3])
    place, first = gru.lanes(lengths, 500)
    assert sorted(place[place >= 0]) == list(range(lengths.sum()))
    assert first.sum() == len(lengths)
    assert place.size <= 2 * lengths.sum() + 20_000
    cut = recurrent_lm.stretches(np.array([1, 1024, 1025, 5000]))
    assert cut.tolist() == [1, 1024, 1024, 1, 1024, 1024, 1024, 1024, 904]


def test_probabilities_add_up():
    model = small_model()
    state = np.random.default_rng(1).standard_normal((1, 6)).astype(np.float32)
    every = [(0, 0), (0, 1), (1, 2), (1, 3), (1, 4), (2, -1), (3, -1)]
    p = [math.exp(model.log_likelihood(state, np.array([c]), np.array([w]))[0]) for c, w in every]
    assert sum(p) == pytest.approx(1, abs=1e-5)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("which", ["given", "edges"])
def test_base_scores(spark, edge_dir, which):
    path = SF if which == "given" else edge_dir
    docs = {r[0]: (r[1] or "").translate(LOWER) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()}
    lists = {i: WORD.findall(t) + [" "] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    counts = collections.Counter(w for i, t in lists.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    rows = recurrent_lm.op1_recurrent_lm(spark, path).collect()
    assert len(rows) == len(docs)
    for r in rows:
        t = lists[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[r["doc_id"]], len(t), sum(w in counts for w in t), n,
        )
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])
    if which == "given":
        unseen = [r for r in rows if r["held_out"]]
        assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_learns_an_order_that_counts_do_not_show(spark):
    """Two languages of one vocabulary each: within a text the next word's language is known."""
    r = random.Random(1)
    text = lambda k: " ".join(f"{'ab'[k]}{r.randrange(40)}" for _ in range(60))
    df = spark.createDataFrame([(i, text(i % 2)) for i in range(1500)], "doc_id long, text string")
    rows = [x for x in recurrent_lm.score_documents(df).collect() if x["held_out"]]
    per_token = sum(x["score"] - x["base_score"] for x in rows) / sum(x["n_tokens"] for x in rows)
    # A few dozen updates go part of the way to log10(2).
    assert per_token > 0.05


def test_scores_awkward_rows(spark, edge_docs):
    got = recurrent_lm.score_documents(edge_docs)
    assert got.count() == edge_docs.count()
    none = spark.createDataFrame([(1, "held out alone")], "doc_id long, text string").where(F.lit(recurrent_lm.held_out(1)))
    assert recurrent_lm.score_documents(none).count() == none.count()


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def rule(host, path):
    best = None
    for verdict, h, p in url_ratio.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best or (None, None)


def model_scores(urls, order, smoothing):
    """The interpolated models in plain Python; urls: string to (weight, label)."""
    grams, seen = {k: collections.defaultdict(lambda: [0, 0]) for k in range(order + 1)}, set()
    for s, (n, label) in urls.items():
        padded = url_ratio.PAD * order + s
        for i in range(order, len(padded)):
            seen.add(padded[i])
            for k in range(order + 1):
                if label:
                    grams[k][padded[i - k : i + 1]][label == "block"] += n
    contexts = {k: collections.defaultdict(lambda: [0, 0]) for k in range(order + 1)}
    for k, table in grams.items():
        for g, n in table.items():
            for side in (0, 1):
                contexts[k][g[:-1]][side] += n[side]

    def p(k, g, side):
        low = 1 / (len(seen) + 1) if k == 0 else p(k - 1, g[1:], side)
        return (grams[k][g][side] + smoothing * low) / (contexts[k][g[:-1]][side] + smoothing)

    out = {}
    for s in urls:
        padded = url_ratio.PAD * order + s
        ratios = [math.log(p(order, padded[i - order : i + 1], 0)) - math.log(p(order, padded[i - order : i + 1], 1)) for i in range(order, len(padded))]
        if ratios:
            out[s] = sum(ratios) / len(ratios)
    return out


HARD_URLS = [
    None, "", "no scheme", "://", "http://", "http://A.Example.NET/en/x?y#z", "http://example.net", "http://net/", "http://x.net?/", "x://notnet.net/",
    "http://example.com/de/", "http://sub.example.com/de/a", "http://anexample.com/de/", "https://a.org/fr/", "https://a.org/frx/", "https://É.org/É/é",
    "http://a.b/c://d", "http://a.b/" + "long/" * 500, "http://a.b/" + "long/" * 500,
]


@pytest.mark.parametrize("which", ["given", "hard"])
def test_urls(spark, which):
    if which == "given":
        pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    else:
        pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(HARD_URLS)], "page_id long, url string, verdict string")
    urls = {r[0]: r[1] for r in pages.select("page_id", "url").collect()}
    counted = collections.Counter("".join(host_path(u)) for u in urls.values())
    labelled = {"".join(host_path(u)): (counted["".join(host_path(u))], rule(*host_path(u))[1]) for u in urls.values()}
    scores = model_scores(labelled, url_ratio.ORDER, url_ratio.SMOOTHING)
    rows = url_ratio.judge_urls(pages).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = host_path(urls[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        name, verdict = rule(host, path)
        assert r["rule"] == name
        score = scores.get(host + path)
        assert (r["score"] is None) == (score is None)
        if score is not None:
            assert r["score"] == pytest.approx(score, abs=1e-9)
        assert r["verdict"] == (verdict or ("allow" if score is not None and score >= r["cut"] else "block"))
    by_label = {v: [scores[s] for s, (n, label) in labelled.items() if label == v and s in scores for _ in range(n)] for v in ("allow", "block")}
    if all(by_label.values()):
        assert np.mean(by_label["block"]) < rows[0]["cut"] < np.mean(by_label["allow"])


def test_cut_without_a_class():
    assert url_ratio.calibrated_cut({"allow": (1.0, 0.5)}) == 0.0
    assert url_ratio.calibrated_cut({"allow": (1.0, 0.0), "block": (0.0, 0.0)}) == 0.5
    assert url_ratio.calibrated_cut({"allow": (2.0, 1.0), "block": (-1.0, 2.0)}) == pytest.approx(1.0)


def test_token_counts_are_the_encoders(spark, edge_dir):
    docs = [(r[0], r[1]) for path in (SF, edge_dir) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    for version, file in rollups.VERSIONS.items():
        counts = rollups.TokenCounts(f"{rollups.FOLDER}/{file}")
        for _, t in docs[::3]:
            if len(t or "") < 20_000:
                assert counts.of(t or "") == len(counts.encode.encode_ordinary(t or ""))


def test_rollup_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    first = {}
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        first.setdefault(r["text"] or "", r["doc_id"])
    counts = {v: rollups.TokenCounts(f"{rollups.FOLDER}/{f}") for v, f in rollups.VERSIONS.items()}
    want = collections.defaultdict(lambda: [0, 0])
    for r in docs:
        if first[r["text"] or ""] == r["doc_id"]:
            version = "byte_bpe_50k" if r["lang"] == "en" else "byte_bpe_multi_50k"
            group = want[r["source"], r["lang"], version]
            group[0] += 1
            group[1] += counts[version].of(r["text"] or "")
    got = {tuple(r)[:3]: list(r)[3:] for r in rollups.op9_delta_rollups(spark, SF).collect()}
    assert got == dict(want)


def test_changes(spark, tmp_path):
    columns = "doc_id long, source string, lang string, tokenizer string, n_tokens long, deleted boolean, seq int, extra string"
    changes = lambda *rows: spark.createDataFrame([(*r, "x") for r in rows], columns)
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    totals = lambda: sorted(tuple(r) for r in rollup.totals().na.fill("-").collect())
    ledger, signed = rollups.apply_changes(
        rollups.empty_ledger(spark),
        changes((1, "a", "en", "v1", 10, False, 0), (1, "a", "en", "v1", 10, False, 0), (2, "a", None, "v1", None, False, 0), (None, None, "en", "v1", 4, False, 0), (3, "b", "en", "v1", 7, False, 0), (3, "b", "en", "v1", 8, False, 1)),
    )
    rollup.commit(1, signed)
    rollup.commit(1, signed)
    first = [("-", "en", "v1", 1, 4), ("a", "-", "v1", 1, 0), ("a", "en", "v1", 1, 10), ("b", "en", "v1", 1, 8)]
    assert totals() == first
    ledger, signed = rollups.apply_changes(ledger, changes((9, "a", "en", "v1", 5, True, 0), (1, "b", "en", "v2", 12, False, 0), (3, "b", "en", "v1", 8, True, 2), (None, "c", "en", "v1", 1, False, 0)))
    rollup.commit(2, signed)
    assert totals() == [("a", "-", "v1", 1, 0), ("b", "en", "v2", 1, 12), ("c", "en", "v1", 1, 1)]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in ledger.collect()) == [(0, 1), (1, 12), (2, 0)]
    _, signed = rollups.apply_changes(ledger, changes())
    rollup.commit(3, signed)
    assert len(totals()) == 3


def test_batches_that_come_again(spark, tmp_path, monkeypatch):
    """Batches replayed on the advanced ledger, and ones that stop before either mark, against a recount."""
    columns = "doc_id long, source string, lang string, tokenizer string, n_tokens long, deleted boolean, seq int"
    batches = {
        1: [(i, "ab"[i % 2], "en", "v1", 10 + i, False, 0) for i in range(20)] + [(None, None, "en", "v1", 4, False, 0)],
        2: [(i, "a", "en", "v1", 0, True, 0) for i in range(5)] + [(7, "c", "de", "v2", 70, False, 0)],
        3: [(3, "a", "en", "v2", 9, False, 0), (7, "c", "de", "v3", 71, False, 0)],
    }
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    real = rollup.marks.mark

    def run(batch_id, stop_at=None):
        def mark(output, *rest):
            if output == stop_at:
                raise ConnectionError("lost")
            real(output, *rest)

        monkeypatch.setattr(rollup.marks, "mark", mark)
        rollup.apply(batch_id, spark.createDataFrame(batches[batch_id], columns))

    def recount(*ids):
        docs = {}
        for b in ids:
            for doc_id, *group, n, deleted, _ in batches[b]:
                docs.pop(doc_id, None)
                if not deleted:
                    docs[doc_id] = (*group, n)
        want = {}
        for *group, n in docs.values():
            was = want.get(tuple(group), (0, 0))
            want[tuple(group)] = (was[0] + 1, was[1] + n)
        return want

    totals = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}
    assert totals() == {} and rollup.ledger().count() == 0
    for done, batch_id in [((), 1), ((1,), 2), ((1, 2), 3)]:
        for stop_at in ("ledgers", "batches"):
            with pytest.raises(ConnectionError):
                run(batch_id, stop_at)
            assert totals() == recount(*done)
        run(batch_id)
        for again in (*done, batch_id):
            run(again)
        assert totals() == recount(*done, batch_id)
    rollup.commit(2, spark.createDataFrame([], "source string, lang string, tokenizer string, docs int, tokens long"))
    assert totals() == recount(1, 2, 3) and rollup.batches() == [1, 2, 3]
    with pytest.raises(ValueError, match="batch 0"):
        rollup.apply(0, spark.createDataFrame(batches[1], columns))


def test_long_urls_cost_no_square(spark):
    """Urls of 200,000 two-byte characters, two of them alike, beside null, empty and short ones."""
    long = "http://a.net/" + "é" * 200_000
    rows = [(1, long), (2, "http://b.example.net/en/" + "xü" * 100_000), (3, None), (4, ""), (5, long), (6, "http://a.org/\U0001f600")]
    judged = url_ratio.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    by_id = {r["page_id"]: r for r in judged}
    assert sorted(by_id) == [1, 2, 3, 4, 5, 6] and by_id[1]["score"] == by_id[5]["score"] < 0 < by_id[2]["score"]
    assert by_id[3]["score"] is None and by_id[4]["verdict"] == "block" and by_id[6]["score"] is not None
