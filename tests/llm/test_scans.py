"""License, secret and URL scans against plain definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from sunframe.llm import common, licenses, secrets, urls
from tests.conftest import SF_LARGER
from tests.llm.edges import EXTRA, ROWS, SECRET, edge_docs, no_docs

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def brute_secrets(text):
    text, found = text or "", []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, (kind, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)), 1):
        for m in re.finditer(pattern, text):
            if m.end() - m.start() >= least:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def documents():
    return dict(zip(*pq.read_table(f"{SF_LARGER}/documents.parquet").select(["doc_id", "text"]).to_pydict().values(), strict=True))


def test_op3_base_equals_the_definition(spark):
    docs = documents()
    rows = licenses.op3_licenses(spark, SF_LARGER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_license(docs[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1 if r["n_base"] else True)
    assert sum(r["n_base"] > 0 for r in rows) > 5


@pytest.mark.parametrize("text", [t for _, t, _ in ROWS] + ["CC-BY cc by CC BY", "apache license apache license", "mit licenses", "xmit license", "é mit license é", "İ MIT License"])
def test_license_base_of_edges(text):
    s = licenses.scanner().scan(text)
    assert (s.n_words, len(s.starts), s.starts[0] if s.starts else None, s.starts[-1] if s.starts else None, ",".join(s.base_labels)) == brute_license(text)


@pytest.mark.parametrize(("text", "label"), [
    ("some text. Licenced under the Apache Licens, Version 2.0 and more", "apache"),
    ("Permission is hereby grantd, free of charge, to any person obtaning a copy of", "mit"),
    ("Redistribution and use in source and binary forms, with or with out modification, are permited", "bsd"),
    ("This Source is subject to the terms of the Mozila Public Licence, v. 2.0", "mpl"),
])
def test_notices_with_edits_are_found_with_their_span(text, label):
    s = licenses.scanner().scan(text)
    assert label in s.labels and 0.8 < s.score < 1
    words = re.findall(r"[0-9a-z]+", ascii_lower(text))
    first, end = next((a, b) for name, a, b, _ in s.spans if name == label)
    notice = next(n for n, lab in licenses.NOTICES if lab == label and abs(len(n.split()) - (end - first)) <= 2)
    assert 0 <= first < end <= len(words) and len(set(words[first:end]) & set(notice.split())) >= 0.5 * len(notice.split())


def test_seeds_find_what_a_full_search_finds():
    import random

    import regex

    r, scanner = random.Random(4), licenses.LicenseScanner()
    for notice, label, edits, _ in scanner._notices:
        for _ in range(4):
            chars = list(notice)
            for _ in range(r.randint(0, edits)):
                at = r.randrange(len(chars))
                r.choice([lambda: chars.pop(at), lambda: chars.insert(at, r.choice("abcxyz")), lambda: chars.__setitem__(at, r.choice("abcxyz"))])()
            text = " lorem ipsum " + "".join(chars) + " dolor sit "
            assert regex.search(f"(?:{regex.escape(notice)}){{e<={edits}}}", text)
            # Words that tell notices apart must stand as they are.
            kept = [w for w in "".join(chars).split() if w in licenses.TELLING] == [w for w in notice.split() if w in licenses.TELLING]
            assert (label in scanner.scan(text).labels) or not kept


@pytest.mark.parametrize(("text", "labels"), [
    ("licensed under CC BY-ND 4.0", ("cc-by", "cc-by-nd")),
    ("Licensed under CC BY-NC 4.0", ("cc-by", "cc-by-nc")),
    ("licensd under CC-BY-NC-SA 4.0", ("cc-by", "cc-by-nc-sa")),
    ("licensed under CC-BY-NC-ND 4.0", ("cc-by", "cc-by-nc-nd")),
    ("we released under the wet license plate", ()),
    ("released under the mat license", ()),
    ("released under the MIT licence", ("mit",)),
    ("licensed under the GNU Lesser General Public Licence", ("lgpl",)),
    ("licensed under the GNU Afferro General Public License", ()),
    ("licensed under the GNU General Public Licence", ("gpl",)),
])
def test_close_notices_are_told_apart(text, labels):
    assert licenses.scanner().scan(text).labels == labels


def brute_notices(text):
    """(label, first word, end word, edits) by a search of the whole text for every notice, without seeds."""
    import regex

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))
    joined, found = " " + " ".join(words) + " ", []
    for notice, label in licenses.NOTICES:
        most = max(1, len(notice) // licenses.CHARS_PER_EDIT)
        todo = [(0, len(joined))]
        while todo:
            low, high = todo.pop()
            m = regex.search(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={most}}}", joined[low:high])
            if not m:
                continue
            start, stop = low + m.start(), low + m.end()
            todo += [(low, start), (stop, high)]
            place, touched = 0, []
            for k, w in enumerate(words):
                a = place + 1
                place = a + len(w)
                if a < stop and place > start:
                    touched.append(k)
            telling = [words[k] for k in touched if words[k] in ("nc", "sa", "nd", "mit", "lesser", "affero")]
            if telling == [w for w in notice.split() if w in ("nc", "sa", "nd", "mit", "lesser", "affero")]:
                found.append((14 * sum(m.fuzzy_counts) - len(notice), -len(notice), touched[0], touched[-1] + 1, label, sum(m.fuzzy_counts)))
    taken, out = set(), []
    for _, _, first, end, label, edits in sorted(found):
        if not taken & set(range(first, end)):
            taken |= set(range(first, end))
            out.append((label, first, end, edits))
    return sorted(out, key=lambda s: s[1:])


def test_op3_labels_spans_and_score_equal_a_search_of_whole_documents(spark):
    r = random.Random(31)
    texts = [t for t in documents().values() if t and len(t) < 900][:30]
    docs = []
    for i, text in enumerate(texts):
        words = text.split()
        for _ in range(r.randint(0, 3)):
            chars = list(r.choice(licenses.NOTICES)[0])
            for _ in range(r.randint(0, 3)):
                chars[r.randrange(len(chars))] = r.choice("aeiou ")
            words.insert(r.randrange(len(words) + 1), "".join(chars))
        docs.append((i, " ".join(words)))
    rows = {x["doc_id"]: x for x in licenses.license_scans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    some = 0
    for i, text in docs:
        want = brute_notices(text)
        assert [tuple(s) for s in rows[i]["spans"]] == want, text
        base = [x for x in brute_license(text)[4].split(",") if x]
        assert rows[i]["labels"] == ",".join(sorted({*base, *(w[0] for w in want)}))
        lengths = {(label, edits): 0 for label, _, _, edits in want}
        shares = [1 - e / len(n) for label, e in lengths for n, own in licenses.NOTICES if own == label]
        assert rows[i]["score"] == 1 if base else (not want and rows[i]["score"] == 0) or any(abs(rows[i]["score"] - s) < 1e-12 for s in shares)
        some += len(want)
    assert some > 15


def test_license_scans_on_edges(spark):
    rows = licenses.license_scans(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    want = sorted((str(i), *map(str, brute_license(t)[:4])) for i, t, _ in ROWS)
    assert sorted((str(x["doc_id"]), *(str(x[c]) for c in ("n_words", "n_base", "first_word", "last_word"))) for x in rows) == want
    assert {x["labels"] for x in rows if x["n_base"]} == {"apache"} and all(x["score"] == 0 for x in rows if x["n_words"] == 0)
    empty = licenses.license_scans(no_docs(spark))
    assert empty.count() == 0 and empty.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_clean_text_has_no_license():
    assert licenses.scanner().scan("A plain story about the sea and the wind, under the stars.").labels == ()


def test_op6_base_equals_the_definition(spark):
    docs = documents()
    rows = secrets.op6_secrets(spark, SF_LARGER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute_secrets(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("markov")] == want
    assert sum(r["n_hex"] for r in rows) > 3


@pytest.mark.parametrize("text", [t for _, t, _ in ROWS] + [
    "PASSWORD = 'abcdef'", "token:abc", "apikey=xxxxxx api_key: yyyyyyy", "ſecret=abcdefgh", "toKen=abcdefgh", "secret = \"\"abcdefgh", "AKIA" * 10, "f" * 23 + "g" + "f" * 24,
    "password=token=abcdefgh", "passwd  :  'aaaaaa' token=bbbbbb", "ABCDEF0123456789ABCDEF0123456789",
])
def test_secret_base_of_edges(text):
    assert [f"{k}:{a}:{b}" for k, a, b in secrets.scanner().scan(text) if k != "markov"] == brute_secrets(text)


def test_markov_models_tell_random_strings_from_identifiers():
    s = secrets.SecretScanner()
    fresh = secrets.labelled_samples(2000, seed=99)
    random_ones, plain, uuids = ([x for label, x in fresh if label == k] for k in ("secret", "identifier", "uuid"))
    caught = sum(bool(s.scan(x)) for x in random_ones)
    assert caught > 0.95 * len(random_ones)
    assert sum(bool(s.scan(x)) for x in plain) < 0.01 * len(plain) and sum(bool(s.scan(x)) for x in uuids) < 0.01 * len(uuids)
    assert s.recall > 0.95
    assert [k for k, _, _ in s.scan("key Zx81kQp0Lm3Rt7Vb9Wc2Yd4Ef end")] == ["markov"]
    assert s.scan("an_ordinary_identifier_with_many_parts_2024 and Supercalifragilisticexpialidocious") == []


@pytest.mark.parametrize("alphabet", [string.ascii_lowercase, string.ascii_uppercase, string.ascii_letters, string.ascii_letters + string.digits, "0123456789ABCDEF"])
def test_secrets_of_letters_alone_and_anywhere_in_long_runs_are_found(alphabet):
    s, r, around = secrets.scanner(), random.Random(3), "directory_entry_" * 20
    for size in (20, 24, 32, 40):
        alone = sum(bool(s.secrets("".join(r.choices(alphabet, k=size)))) for _ in range(300))
        inside = 0
        for _ in range(300):
            at = r.randrange(200)
            run = around[:at] + "".join(r.choices(alphabet, k=size)) + around[: r.randrange(200)]
            inside += any(min(b, at + size) - max(a, at) >= 0.7 * size for a, b in s.secrets(run))
        assert alone >= 0.95 * 300 and inside >= 0.95 * 300, (size, alone, inside)


def brute_segment(steps):
    """The best contiguous part by looking at all of them."""
    best = (0.0, 0, 0)
    for end in range(1, len(steps) + 1):
        for start in range(end - 1, -1, -1):
            total = math.fsum(steps[start:end])
            if total > best[0] + 1e-9:
                best = (total, start, end)
    return best


def brute_stretches(steps, least, low=0):
    total, a, b = brute_segment(steps)
    if total <= least:
        return []

    def cut(x, y):
        fall, p, q = brute_segment([-v for v in steps[x:y]])
        if fall >= secrets.LEAST_SCORE:
            return cut(x, x + p) + cut(x + q, y)
        return [(low + x, low + y)] if y - x >= secrets.LEAST_STRETCH and math.fsum(steps[x:y]) > least else []

    return brute_stretches(steps[:a], least, low) + cut(a, b) + brute_stretches(steps[b:], least, low + b)


def test_stretches_equal_a_search_of_all_segments():
    r = np.random.default_rng(12)
    some = 0
    for _ in range(120):
        steps = r.normal(r.choice([-0.6, -0.2, 0.3]), 2.0, r.integers(1, 70)) + np.repeat(r.choice([-2.0, 0.0, 2.0], 7), 10)[: r.integers(1, 2)]
        steps = steps + 2.5 * np.sin(np.arange(len(steps)) / r.uniform(2, 9))
        got = [(a, b) for _, a, b in secrets.stretches(steps, 12.0)]
        assert got == brute_stretches(steps.tolist(), 12.0)
        some += len(got)
    assert some > 60


def brute_markov(text, s):
    """Markov spans of a text by the definition: candidate runs less base spans, the best stretches of all chains first."""
    base = [(int(a), int(b)) for a, b in (x.split(":")[1:] for x in brute_secrets(text))]
    spans = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        free = [i for i in range(*m.span()) if not any(a <= i < b for a, b in base)]
        parts = []
        for i in free:
            if parts and parts[-1][-1] == i - 1:
                parts[-1].append(i)
            else:
                parts.append([i])
        for part in parts:
            steps, found = s.steps(text[part[0] : part[-1] + 1]), []
            for row in steps:
                found += [(-math.fsum(row[a:b]), a, b) for a, b in brute_stretches(row.tolist(), s.threshold)]
            used: set[int] = set()
            for _, a, b in sorted(found):
                if not used & set(range(a, b)):
                    used |= set(range(a, b))
                    spans.append((part[0] + a, part[0] + b))
    return sorted(spans)


def test_markov_spans_of_texts_equal_brute_force():
    # Two chains, so that the plain search of all segments stays quick.
    samples = [(k, x) for k, x in secrets.labelled_samples(900) if k != "uuid" and (k != "secret" or not x.isalpha())]
    s, r = secrets.SecretScanner(samples), random.Random(21)
    found = 0
    for _ in range(25):
        parts = [r.choice(["an_ordinary_name_of_a_thing", "token=" + "x" * r.randint(3, 9), "".join(r.choices(string.ascii_letters + string.digits, k=r.randint(18, 30))), "/", " ", "0123456789abcdef" * 2, "----"]) for _ in range(r.randint(2, 5))]
        text = "".join(parts)
        got = [(a, b) for k, a, b in s.scan(text) if k == "markov"]
        assert got == brute_markov(text, s), text
        found += len(got)
    assert found > 10


def test_labelled_samples_of_a_table_teach(spark):
    docs = spark.createDataFrame([(1, "order ref QJXKWVZQ-QXJKVWZQ-XJQKZWVQ here")], "doc_id long, text string")
    assert "markov" in secrets.secret_scans(docs).first()["spans"]
    r = random.Random(2)
    refs = [("order", "-".join("".join(r.choices("QJXKWVZ", k=8)) for _ in range(3))) for _ in range(400)]
    table = spark.createDataFrame([*refs, (None, "x"), ("secret", None)], "label string, text string")
    assert secrets.secret_scans(docs, table).first()["spans"] == ""


def test_a_corpus_teaches_its_own_words(spark):
    r = random.Random(6)
    words = ["".join(r.choices(["zqu", "xov", "wyk", "jib", "vlo"], k=4)) for _ in range(300)]
    rows = [(i, " ".join(r.choices(words, k=40)) + " " + "_".join(r.choices(words, k=3))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(bool(secrets.scanner().scan(t)) for _, t in rows) > 20
    assert sum(x["spans"] != "" for x in secrets.secret_scans(docs).collect()) <= 2


def test_an_edited_notice_before_an_exact_one_is_found():
    for notice, label in licenses.NOTICES:
        edited = notice[:-3] + ("x" if notice[-3] != "x" else "y") + notice[-2:]
        for text, edits in ((f"{edited} {notice}", [1, 0]), (f"{notice} {edited}", [0, 1]), (f"{edited} {notice} {edited}", [1, 0, 1])):
            spans = licenses.scanner().scan(text).spans
            assert [s[3] for s in spans if s[0] == label and s[2] - s[1] == len(notice.split())] == edits, (notice, spans)


@pytest.mark.parametrize("before", ["/users/password/reset/confirm/", "/static/documents/public/download/session/", "authorization_code=", "-" * 40, "directory_" * 5 + "entry_"])
@pytest.mark.parametrize("after", ["", "/profile/settings/overview", "=" * 40])
def test_ordinary_surroundings_hide_no_secret(before, after):
    s, r = secrets.scanner(), random.Random(11)
    for size, least in ((20, 0.9), (24, 0.95), (32, 0.97), (40, 0.97)):
        found = 0
        for _ in range(200):
            text = f"x {before}{''.join(r.choices(string.ascii_letters + string.digits, k=size))}{after} y"
            at = 2 + len(before)
            spans = [(max(a, at), min(b, at + size)) for k, a, b in s.scan(text) if k == "markov"]
            found += sum(b - a for a, b in spans if b > a) >= 0.7 * size
        assert found >= least * 200, (size, found)
    assert not s.scan(f"x {before}{after} y")


def test_a_base_span_hides_no_secret_beside_it():
    text = "0123456789abcdef0123456789abcdef_" + "Zx81kQp0Lm3Rt7Vb9Wc2Yd4EfQ"
    assert [k for k, _, _ in secrets.scanner().scan(text)] == ["hex", "markov"]


def test_secret_edges_and_redaction(spark):
    docs = edge_docs(spark)
    assert secrets.secret_scans(docs).count() == len(ROWS)
    assert secrets.secret_scans(no_docs(spark)).count() == 0
    out = secrets.redact_secrets(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(ROWS)
    by_id = {r["doc_id"]: r for r in rows}
    assert "hunter2" not in by_id[8]["text"] and "AKIA" not in by_id[8]["text"] and by_id[8]["n_chars"] == len(by_id[8]["text"]) != len(SECRET)
    assert by_id[3]["text"] is None and by_id[1]["text"].startswith("The quick")
    assert all(r[c] == f"own {c}" for r in rows for c in EXTRA)
    assert secrets.redacted(secrets.redacted(SECRET)) == secrets.redacted(SECRET)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = ascii_lower(re.split(r"[/?#]", rest, maxsplit=1)[0])
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best and best[2]


def test_op9_equals_the_definition(spark):
    pages = dict(zip(*pq.read_table(f"{SF_LARGER}/pages.parquet").select(["page_id", "url"]).to_pydict().values(), strict=True))
    rows = urls.op9_urls(spark, SF_LARGER).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule, verdict = brute_rule(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")


PAGES = [
    (1, "http://A.example.net/x", '<link rel="canonical" href="https://b.com/de/1">'),
    (2, "http://c.example.net/", '<LINK href=/landing rel="nofollow canonical">'),
    (3, "http://c.example.net/landing#top", '<meta http-equiv="refresh" content="0; url=http://a.example.net/x?z=1">'),
    (4, "http://d.net/y?q=1", '<link rel="canonical" href="http://a.example.net/x#part">'),
    (5, "http://x.com/fr/1", '<link rel="canonical" href="http://b.com/de/1">'),
    (6, "http://free.net/", '<link rel="stylesheet" href="http://b.com/de/1"><a rel=canonical href="http://b.com/de/1">'),
    (7, None, '<link rel="canonical" href="http://b.com/de/1">'),
    (8, "no scheme", "<html>"),
    (9, "https://b.com/de/1", None),
    (10, "https://only.net", '<link rel=canonical href="https://only.net/">'),
    (11, "http://e.net/", '<link rel="canonical" href="https://B.COM/de/1?a=1&amp;b=2">'),
    (12, "http://EXAMPLE.org?x", ""),
    (None, "http://sub.example.org:80/en/1", ""),
    (13, "http://example.org/en/1", ""),
    (13, "http://example.org/en/1", ""),
    (14, "http://bad.net/", '<link rel="canonical" href="http://[bad/">'),
]


def test_aliases_share_a_block_unless_allowed(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("node", F.lit("own")).withColumn("alias", F.lit(1))
    got = {(r["page_id"], r["host"]): r for r in urls.judge(df).collect()}
    verdict = {k[0]: r["verdict"] for k, r in got.items()}
    assert [verdict[i] for i in (1, 4)] == ["block", "block"]
    assert [verdict[i] for i in (2, 3)] == ["allow", "allow"]  # x?z=1 is another URL than x
    assert verdict[5] == "allow" and got[5, "x.com"]["rule"] == "com/fr/"
    assert [verdict[i] for i in (6, 7, 8, 10, 14)] == ["allow"] * 5
    assert verdict[9] == "block" and verdict[11] == "block" and verdict[13] == "block"
    assert got[12, "example.org"]["path"] == "" and got[12, "example.org"]["rule"] is None
    assert urls.judge(df).count() == len(PAGES)
    seen = spark.createDataFrame([("http://c.example.net/landing", "http://a.example.net/x"), (None, "http://z.net/")], "source string, target string")
    verdict = {r["page_id"]: r["verdict"] for r in urls.judge(df, redirects=seen).collect()}
    assert verdict[2] == verdict[3] == "block"
    assert urls.judge(df.limit(0)).count() == 0


def test_sql_closes_over_aliases_too(spark):
    import duckdb

    rows = [(1, "http://a.net/x", '<link rel="canonical" href="http://b.net/y">'), (2, "http://b.net/y", '<link rel="canonical" href="http://c.com/de/z">'), (3, "http://d.net/", ""), (4, "http://m.com/fr/", '<link rel="canonical" href="http://a.net/x">')]
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    want = sorted(con.execute(urls.OP9_SQL).fetchall())
    got = sorted(tuple(r) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == want and [r[4] for r in got] == ["block", "block", "allow", "allow"]


def brute_verdict(url, rules):
    host, path, _, _ = brute_rule(url)
    if not host:
        return None, None
    best = None
    for suffix in [host.split(".", k)[k] for k in range(host.count(".") + 1)]:
        for n in range(len(path) + 1):
            for what in ("allow", "block"):
                if (what, suffix + path[:n]) in rules and (best is None or len(suffix) + n > len(best[0])):
                    best = (suffix + path[:n], what)
    return best or (None, None)


@pytest.mark.parametrize("hot", [1_000_000, 5])
def test_a_hundred_thousand_rules_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_KEYS", 1_000_000_000)
    monkeypatch.setattr(common.spread_join, "__defaults__", ("inner", None, hot))
    r = random.Random(17)
    words = ["a", "b", "news", "shop", "en", "de", "x1"]

    def host():
        return ".".join(r.choices(words, k=r.randint(1, 3))) + r.choice([".com", ".org", ".net"])

    rules = {(r.choice(["allow", "block"]), f"h{i}.com/{i % 7}") for i in range(100_000)}
    rules |= {(r.choice(["allow", "block"]), host() + r.choice(["", "/", "/en", "/en/1", "/de/"])) for _ in range(400)} | {("block", "org/"), ("allow", "org/"), ("allow", "org")}
    pages = [(i, r.choice(["http://", "HTTPS://", "", "x://"]) + host().upper() + r.choice(["", "/", "/en/1?q", "/de/x#y", "/en"]), "") for i in range(300)]
    pages += [(1000 + i, f"http://www.h{i * 300}.com/{i % 7}/z", None) for i in range(100)] + [(None, None, None), (7, "http://a.com/en", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    table = spark.createDataFrame([*rules, (None, "x.com/"), ("block", None)], "verdict string, rule string")
    got = sorted((str(x["page_id"]), x["host"], x["path"], str(x["rule"]), x["verdict"]) for x in urls.judge(df, table).collect())
    want = []
    for i, url, _ in pages:
        found, what = brute_verdict(url, rules)
        want.append((str(i), *brute_rule(url)[:2], str(found), what or "allow"))
    assert got == sorted(want)
    if hot > 5:
        return
    some = [*rules][:200]
    assert urls.judge(df, some).exceptAll(urls.judge(df, spark.createDataFrame(some, "verdict string, rule string"))).isEmpty()


def test_long_rule_lists_spread_over_aliases_too(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    long = [*urls.RULES, *(("block", f"h{i}.example/") for i in range(100))]
    assert sorted(map(str, urls.judge(df, long).collect())) == sorted(map(str, urls.judge(df).collect()))
    assert urls.judge(df.limit(0), long).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_joins_of_hot_keys_lose_nothing(spark, monkeypatch, how):
    monkeypatch.setattr(common, "HOT_KEYS", 1_000_000_000)
    many = spark.range(300).selectExpr("id", "if(id % 3 = 0, 7, id % 20) as k").union(spark.sql("select 999L, null"))
    one = spark.range(0, 15).selectExpr("id as key", "id * 10 as v").union(spark.sql("select 3L, 31L"))
    want = sorted(map(str, many.join(one, many["k"] == one["key"], how).collect()))
    assert sorted(map(str, common.spread_join(many, one, {"k": "key"}, how, hot_rows=9).collect())) == want


def test_models_and_threshold_come_from_every_document(spark):
    """6,000 documents, each word in two of them: counts and the threshold equal those of all words, by a plain loop."""
    r = random.Random(12)
    parts = ["zqu", "xov", "wyk", "jib", "vlo", "Q7", "_k"]
    words = sorted({"".join(r.choices(parts, k=r.randint(4, 12))) for _ in range(9000)})
    places = [w for w in words for _ in range(2)]
    r.shuffle(places)
    texts = [" ".join(places[i::6000]) for i in range(6000)] + ["token=abcdef lonely_word_of_a_secret lonely_word_of_a_secret", "once_only_and_nowhere_else"] * 2
    model = secrets.trained(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))

    where = {}
    for text in texts:
        if not re.search(secrets._BASE, text):
            for w in re.findall(secrets.WORD, text):
                where.setdefault(w, set()).add(text)
    plain = [(w, xxhash.xxh64_intdigest(w, 42) % 2) for w, t in where.items() if len(t) > 1]
    assert len(plain) > 8000
    samples = secrets.labelled_samples()
    made = [x for k, x in samples if k == "identifier"]
    counts = secrets.triples([*made[::2], *(w for w, half in plain if not half)]) + secrets.triples([w.upper() for w, half in plain if not half]) / 4
    hexes = [x for x in [x for k, x in samples if k == "secret"][::2] if re.fullmatch("[0-9a-f]*", x)]
    want = secrets.chain(hexes) - secrets.smoothed(counts)
    assert any(np.allclose(want, ratio, atol=1e-4) for ratio in model._ratio)
    scores = [(model.score(x), 4) for x in made[1::2]]
    scores += [(model.score(x), weight) for w, half in plain if half and len(w) >= 20 for x, weight in ((w, 4), (w.upper(), 1))]
    total, below = sum(n for _, n in scores), 0
    for score, n in sorted(scores):
        below += n
        if below > (1 - secrets.FALSE_SHARE) * total:
            break
    assert model.threshold == max(secrets.LEAST_SCORE, score) and score > secrets.LEAST_SCORE
