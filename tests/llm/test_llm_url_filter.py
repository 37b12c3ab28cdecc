import itertools
import math
import random

from hostpulse.llm import url_filter as uf


def plain_rule(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for verdict, name, start in uf.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start) and (best is None or len(name + start) > len(best[0])):
            best = (name + start, verdict)
    return host, path, best


def test_hosts_paths_and_longest_rule(spark):
    random.seed(2)
    parts = ["http", "://", "www.", "example.com", "net", "/en/", "/es/", "?", "#", "/", "x.", "COM", "é", "\n", "example.com/en/", "@"]
    urls = ["".join(random.choices(parts, k=random.randint(0, 8))) for _ in range(500)]
    urls += [None, "", "http://a.net/fr/1", "https://WWW.Example.COM/en/a?b#c", "http://example.com/en/", "http://com", "x://net/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'clash' as host", "cast(null as string) as html")
    model = uf.UrlModel({}, -1.0, {}, 0.0)
    for r in uf.judge(pages, model).collect():
        host, path, best = plain_rule(urls[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path), urls[r["page_id"]]
        assert (r["rule"], r["verdict"]) == (best or (None, "allow")), urls[r["page_id"]]


def test_segmentation_is_the_cheapest_split():
    random.seed(7)
    segmenter = uf.Segmenter({"free": 9, "bets": 5, "bet": 7, "casino": 4, "win": 6, "a": 20, "as": 8, "in": 30})
    assert segmenter.split("freecasinobets") == ["free", "casino", "bets"]
    cost = lambda words: sum(segmenter.cost.get(w, segmenter.unknown + 3.0 * len(w)) for w in words)
    for _ in range(60):
        run = "".join(random.choice("abfreetswinco") for _ in range(random.randint(1, 10)))
        best = min(
            cost([run[a:b] for a, b in zip((0, *cuts), (*cuts, len(run)))])
            for n in range(len(run)) for cuts in itertools.combinations(range(1, len(run)), n)
        )
        assert math.isclose(cost(segmenter.split(run)), best) and "".join(segmenter.split(run)) == run


def test_joined_spam_words_are_blocked(spark):
    rows = [(i, f"https://site{'abcde'[i % 5]}.example.org/en/{i}", "<p>some free words about casino nights and news</p>") for i in range(200)]
    rows += [(500 + i, f"http://m.freecasino{'xyz'[i % 3]}.example.org/p/{i}", "<b>win win</b>") for i in range(30)]
    rows += [(900, None, None), (901, "no url", "<p>"), (902, "http://m.freecasinow.example.org/", "x"), (902, "http://m.freecasinow.example.org/", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in uf.judge(pages, uf.fit(pages)).collect()}
    assert {got[i]["verdict"] for i in range(200)} == {"allow"}
    assert {got[500 + i]["verdict"] for i in range(30)} == {"block"} and got[902]["verdict"] == "block"
    assert got[900]["verdict"] == "allow" and got[900]["rule"] is None and "h:casino" in got[500]["tokens"]


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    model = uf.fit(empty)
    assert uf.judge(empty, model).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/x", None)], "page_id long, url string, html string")
    assert uf.judge(one, uf.fit(one)).first()["verdict"] == "allow"


def test_every_token_has_its_own_odds(spark):
    letters = "bcdfghjklm"
    tail = ["".join(letters[int(d)] for d in f"{i:05}") + "zzz" for i in range(52_000)]
    rows = [(i, f"http://m.example.org/{w}/{w}", None) for i, w in enumerate(tail)] + [(60_000, "http://m.casino.example.org/win", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = uf.fit(pages, ["casino"])
    odds = {r["token"]: r["odds"] for r in model.odds.collect()}
    assert {f"p:{w}" for w in tail} < odds.keys() and "h:casino" in odds
    a, b, v = 5 * 52_000, 5, len(odds) + 1
    assert math.isclose(model.unseen, math.log((a + v) / (b + v)))
    assert math.isclose(odds[f"p:{tail[7]}"], math.log(1 / (b + v)) - math.log(3 / (a + v)))
    got = {r["page_id"]: r for r in uf.judge(pages, model).collect()}
    assert len(got) == len(rows) and {got[i]["verdict"] for i in range(52_000)} == {"allow"}
    assert math.isclose(got[7]["score"], model.prior + sum(odds[t] for t in got[7]["tokens"]))


def test_rare_words_keep_their_own_counts(spark):
    letters = "bcdfghjklm"
    common = ["".join(letters[int(d)] for d in f"{i:05}") for i in range(51_000)]
    html = " ".join(f"{w} {w}" for w in common) + " sus sus sus sus sus sussex"
    pages = spark.createDataFrame([(1, "http://m.org/sussex", html), (2, "http://m.org/zq/Sussex/" + "q" * 30_000, None)], "page_id long, url string, html string")
    words = uf.word_counts(pages)
    counts = {r["word"]: r["count"] for r in words.collect()}
    assert counts["sussex"] == 1 and counts["sus"] == 5 and counts["sex"] == 2 and len(counts) == 51_002 + len(uf.SEEDS)
    got = {r["path"]: r["tokens"] for r in uf.segmented(pages, words).collect()}
    assert got["/sussex"] == ["h:m", "h:org", "p:sussex"]
    assert got["/zq/Sussex/" + "q" * 30_000][:4] == ["h:m", "h:org", "p:zq", "p:sussex"]
    whole = uf.Segmenter(counts)
    assert got["/zq/Sussex/" + "q" * 30_000][4:] == [f"p:{w}" for w in whole.split("q" * 30_000)]


def test_long_runs_of_many_substrings_and_open_tags(spark):
    """100,000 letters that hardly repeat in a url; a megabyte of tags that never close."""
    random.seed(5)
    run = "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    rows = [(1, f"http://m.org/{run}", "<" * 1_000_000), (2, "http://m.org/abc", f"<p>abc {run[5_000:5_012]} {run[4_995:5_004]}</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    words = uf.word_counts(pages)
    got = {r["path"]: r["tokens"] for r in uf.segmented(pages, words).collect()}
    whole = uf.Segmenter({r["word"]: r["count"] for r in words.collect()})
    assert got[f"/{run}"][2:] == [f"p:{w}" for w in whole.split(run)] and len(got[f"/{run}"]) > 2_000
