"""Url filters, quality rules, quality classifier, language id and packing."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftlake.llm import langid, packing, pu_quality, quality_rules, queries, textkit, url_rules

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "   \n\t ", "x", "Ünïcode 漢字 🙂\x0bone", "a b " * 3000, "The same line\nThe same line\n", "!!! ??? | | |", "der die das " * 20]


def odd_docs(spark):
    rows = [(k, t, "clash") for k, t in enumerate(ODD)] + [(None, "null id", "c"), (3, "x", "c"), (3, "x", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def test_words_and_windows_against_plain_python():
    import pyarrow as pa

    texts = ODD + ["a b c d e f a b c d e f"]
    data, off = textkit.text_buffer(pa.array(texts, pa.string()))
    w = textkit.Words(data, off, lower=True)
    plain = [WORD.findall((t or "").lower() if (t or "").isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    assert np.diff(w.off).tolist() == [len(p) for p in plain]
    at, h = w.windows(3)
    doc = w.doc()[at]
    seen = collections.defaultdict(set)
    k = 0
    for d, p in enumerate(plain):
        for i in range(len(p) - 2):
            assert doc[k] == d
            seen[tuple(p[i : i + 3])].add(int(h[k]))
            k += 1
    assert k == len(h) and all(len(v) == 1 for v in seen.values()) and len({*map(tuple, seen.values())}) == len(seen)


def test_url_filter_odd_rows(spark):
    urls = [None, "", "nohost", "http://A.Example.ORG/es/x?y#z", "http://org", "https://org/", "x://notorg/", "http://h.com/de/a", "http://h.com/de",
            "http://example.org/en/12", "http://example.org/EN/1", "http://my.casino-x.net/a", "http://h.com?x=/fr/"]
    df = spark.createDataFrame([(k, u, "c") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_rules.url_filter(df, url_rules.SITE_RULES + url_rules.PATTERNS).collect()}
    assert [got[k].rule for k in range(len(urls))] == [None, None, None, "example.org/es/", None, "org/", None, "com/de/", None, "example.org/en/1", "org/", None, None]
    assert got[11].verdict == "block" and got[11].pattern == "gambling-host" and got[3].host == "a.example.org" and got[12].path == ""
    assert url_rules.url_filter(df.limit(0), url_rules.SITE_RULES).count() == 0
    with pytest.raises(ValueError):
        url_rules.url_filter(df, [url_rules.pattern_rule("none", "x")])


def plain_statistics(t):
    t = t or ""
    w = WORD.findall(t)
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_quality_rules_statistics(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit("c").alias("score")).unionByName(odd_docs(spark))
    for r in quality_rules.with_statistics(docs).collect():
        assert tuple(r[c] for c in quality_rules.BASE) == plain_statistics(r.text), r.doc_id


def test_decision_list_learns_and_orders(spark):
    rng = np.random.default_rng(0)
    x = rng.random((900, len(quality_rules.FEATURES)))
    bad = (x[:, 2] > 0.9) | ((x[:, 5] < 0.2) & (x[:, 7] >= 0.5))
    rules = quality_rules.learn(x, bad)
    hit = np.any([quality_rules.covers(r, x) for r in rules], axis=0)
    assert (hit == bad).mean() > 0.97
    assert quality_rules.learn(x[:0], bad[:0]) == []
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    out = quality_rules.quality_rules(docs, quality_rules.fit(docs, labels))
    assert out.count() == docs.count() and out.where("rule is not null").count() == 0
    assert quality_rules.quality_rules(docs.limit(0), []).count() == 0


def test_quality_rules_reject_junk(spark):
    out = queries.op8_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    r = out.where("not base_failed").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert r > 0.95


def test_quality_classifier_held_out(spark):
    out = queries.op1_quality_classifier(spark, SF)
    assert out.count() == 1000 and out.where("score is null or score < 0 or score > 1").count() == 0
    held = out.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93


def test_quality_classifier_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(8, 1), (4, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        model = pu_quality.fit(docs, known)
        rows = pu_quality.score(docs, model, keep=("doc_id", "score")).collect()
        assert len(rows) == docs.count() and all(0 <= r.quality_score <= 1 for r in rows)
    assert pu_quality.score(docs.limit(0), model).count() == 0
    assert pu_quality.fit(docs.limit(0), labels.limit(0)).score(np.zeros((1, len(pu_quality.NAMES)))) == pytest.approx(0.5)


def plain_bits(tree_counts, text, order):
    """Prediction by partial matching, byte by byte with explicit exclusion sets."""
    total = 0.0
    b = bytes([10] * order) + text.encode()
    for i in range(order, len(b)):
        gone: set = set()
        for j in range(order, -1, -1):
            after = tree_counts.get(b[i - j : i], {})
            free = {s: n for s, n in after.items() if s not in gone}
            if not after:
                continue
            if b[i] in free:
                total -= np.log2(free[b[i]] / (sum(free.values()) + len(free)))
                break
            if free:
                total -= np.log2(len(free) / (sum(free.values()) + len(free)))
            gone |= set(after)
        else:
            total += np.log2(256 - len(gone))
    return total


def test_context_tree_code_lengths_are_exact():
    import pyarrow as pa

    train = ["the cat sat on the mat", "then the hat", "çà et là"]
    counts: dict = collections.defaultdict(collections.Counter)
    for t in train:
        b = b"\n" * 3 + t.encode()
        for i in range(3, len(b)):
            for j in range(4):
                counts[b[i - j : i]][b[i]] += 1
    _, g, n = langid.grams(*textkit.text_buffer(pa.array(train)))
    tree = langid.ContextTree(g, n.astype(float))
    for t in ["the cat", "zebra", "là là", "", "tht\n"]:
        _, g, n = langid.grams(*textkit.text_buffer(pa.array([t])))
        assert (tree.bits(g) * n).sum() == pytest.approx(plain_bits(counts, t, 3))


def test_language_id(spark):
    out = queries.op6_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(docs, "doc_id").collect()
    assert out.count() == 1000 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    known = spark.createDataFrame([(1, "the and of", "en"), (2, "der die das", "de"), (3, None, "de"), (4, "x", None)], "doc_id long, text string, lang string")
    got = langid.identify(odd_docs(spark), langid.fit(known), keep=("score",)).collect()
    assert len(got) == len(ODD) + 3
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[0] == by[1] == by[2] == by[7] == "und" and by[8] == "de"
    assert {r.lang_pred for r in langid.identify(odd_docs(spark), langid.fit(known.limit(0))).collect()} == {"und"}
    assert langid.identify(odd_docs(spark).limit(0), langid.fit(known)).count() == 0


def check_pieces(rows, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    seqs, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
        docs[r.doc_id].append(r)
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0  # nothing is padded
    for d, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(docs[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)


def test_packing_covers_every_token(spark):
    rows = queries.op2_packing(spark, "/root/testdata/sf0.001").collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check_pieces(rows, texts)


def test_packing_odd_rows_and_balance(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate([*ODD, "end <|endoftext|> more"])], "doc_id long, text string, offset int")
    out = packing.pack(docs, queries.tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))
    check_pieces(out.collect(), [(k, t) for k, t in enumerate([*ODD, "end <|endoftext|> more"])])
    assert packing.pack(docs.limit(0), queries.tokenizer_path()).count() == 0
    named = packing.pack(docs.select(F.col("doc_id").cast("string"), "text"), queries.tokenizer_path())
    assert named.select("doc_id").distinct().count() == len(ODD) + 1
    sizes = [1024] * 40 + [512] * 7 + [128] * 9
    load = np.bincount(packing.step_groups(sizes, 8192), weights=sizes)
    assert load.max() - load.min() <= 512


def _matches(regex):
    """Strings that fit the expression, one at least for each way through its groups."""
    import itertools
    from re import _parser

    def ways(seq):
        return ["".join(x) for x in itertools.product(*(one(op, arg) for op, arg in seq))]

    def one(op, arg):
        name = str(op)
        if name == "LITERAL":
            return [chr(arg)]
        if name == "AT":
            return [""]
        if name == "IN":
            return [chr(v) if str(k) == "LITERAL" else chr(v[0]) if str(k) == "RANGE" else "h" for k, v in arg]
        if name == "NOT_LITERAL":
            return ["h"]
        if name == "SUBPATTERN":
            return ways(arg[3])
        if name == "BRANCH":
            return [w for branch in arg[1] for w in ways(branch)]
        if name == "MAX_REPEAT":
            return [w for w in dict.fromkeys([*([""] if arg[0] == 0 else []), *ways(arg[2])])]
        raise NotImplementedError(name)

    found = [w for w in dict.fromkeys(ways(_parser.parse(regex))) if re.search(regex, w)]
    assert found
    return found


def test_every_match_of_a_pattern_is_fetched(spark):
    for r in url_rules.PATTERNS:
        for m in _matches(r.regex):
            held = set(re.split("[^a-z0-9]+", m.lower()))
            assert all(held & set(alt) for alt in r.alternatives()), (r.name, m)
    urls = [f"http://{m}" for r in url_rules.PATTERNS for m in _matches(r.regex) if not m.startswith("/")]
    urls += ["http://adserver.x.net/banner/1", "http://ads.x.net/click", "http://ads.adserver.net/click/1", "http://adserverx.net/banner/1"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    for r in url_rules.url_filter(df, url_rules.PATTERNS).collect():
        first = next((p.name for p in url_rules.PATTERNS if re.search(p.regex, r.host + r.path)), None)
        assert (r.pattern, r.verdict) == (first, "block" if first else "allow"), r.url


def test_thousands_of_rules_from_files(spark, tmp_path):
    """Rules read from files, against a plain loop over all rules, on the given urls and on urls
    that the rules meet."""
    import json

    pages = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()]
    lines = [{"verdict": "block" if k % 3 else "allow", "host": f"site{k}.example.net", "path": f"/part{k % 11}/"} for k in range(2000)]
    lines += [{"verdict": "block", "host": "example.org", "path": f"/en/{k}"} for k in range(0, 900, 7)]
    lines += [{"verdict": "allow", "host": "Net"}]
    lines += [{"verdict": "block", "name": f"p{k}", "regex": f"/(pill{k}|spin{k})/[0-9]+$", "literals": [[f"pill{k}", f"spin{k}"]]} for k in range(2000)]
    lines += [{"verdict": "allow", "name": "good", "regex": "^good[.-]", "literals": [["good"]]}]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(x) for x in lines[:3000]) + "\n\n")
    (tmp_path / "b.json").write_text("\n".join(json.dumps(x) for x in lines[3000:]))
    rules = url_rules.read_rules(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    assert len(rules) == len(lines) and rules[-1].name == "good" and rules[0].name == "site0.example.net/part0/"
    urls = pages + [None, "", *[f"https://w{k}.SITE{k}.example.net/part{(k + k % 2) % 11}/x" for k in range(0, 2000, 37)], "http://good.com/pill7/12"]
    urls += [f"http://h{k}.com/a/{'spin' if k % 2 else 'pill'}{k}/{k}" for k in range(0, 2000, 41)] + ["http://h.com/pill5/x", "http://xsite1.example.net/part1/"]
    df = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    met = collections.Counter()
    compiled = [(x, re.compile(x.regex)) for x in rules]
    for r in url_rules.url_filter(df, rules).collect():
        fits = [x for x, c in compiled if c.search(r.host + r.path)]
        best = max((x for x in fits if x.site), key=lambda x: len(x.name), default=None)
        first = next((x for x in fits if not x.site), None) if best is None else None
        want = best or first
        assert (r.rule, r.pattern, r.verdict) == (best and best.name, first and first.name, want.verdict if want else "allow"), r.url
        met[(r.rule is not None, r.pattern is not None)] += 1
    assert met[(True, False)] > 50 and met[(False, True)] > 40 and met[(False, False)] > 100
    for bad in ({"verdict": "maybe", "host": "a"}, {"verdict": "block"}, {"verdict": "block", "regex": "x"}):
        (tmp_path / "c.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            url_rules.read_rules(spark, str(tmp_path / "c.json"))


def plain_features(t):
    t = t or ""
    n, chars, symbols, dups, repeats = plain_statistics(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    w, c, m = max(n, 1), max(chars, 1), max(len(lines), 1)
    upper, marks = len(re.findall("[A-Z]", t)), len(re.findall("[!?]", t))
    return [float(n), chars / w, symbols / c, dups / m, repeats / w, len(set(WORD.findall(t))) / w, upper / c, marks / c, n / m]


def test_kept_of_the_query_against_a_plain_decision_list(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality_rules.fit(docs.select("doc_id", "text"), labels)
    got = {r.doc_id: r for r in queries.op8_quality_rules(spark, SF).collect()}
    assert rules
    for d in docs.select("doc_id", "text").collect():
        x, s = plain_features(d.text), plain_statistics(d.text)
        fits = [all((x[c.feature] >= c.cut) == c.at_least for c in rule) for rule in rules]
        failed = s[0] < 20 or 100 * s[4] > 30 * s[0]
        rule = f"rule{fits.index(True) + 1}" if any(fits) else None
        assert (got[d.doc_id].base_failed, got[d.doc_id].rule, got[d.doc_id].kept) == (failed, rule, not failed and rule is None), d.doc_id
