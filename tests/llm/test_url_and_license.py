import pytest

from gridseries.llm import license_scan, url_filter

URLS = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("https://EXAMPLE.net/en/1?q#f", "example.net", "/en/1", "example.net/en/", "allow"),
    ("https://sub.example.net/english", "sub.example.net", "/english", "net/", "block"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("https://x.org/fr/a", "x.org", "/fr/a", "org/fr/", "allow"),
    ("ftp://a.net", "a.net", "", None, "allow"),
    ("https://a.net?x=/y", "a.net", "", None, "allow"),
    ("no scheme.net/x", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://net/", "net", "/", "net/", "block"),
]


def test_fixed_rules_with_odd_urls_repeats_and_extra_columns(spark):
    rows = [(i, u, "h", "r") for i, (u, *_) in enumerate(URLS)] + [(None, URLS[0][0], "h", "r"), (0, URLS[0][0], "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = url_filter.filter_urls(pages).collect()
    by_id = {r["page_id"]: tuple(r)[1:] for r in got}
    assert len(got) == len(rows)
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert by_id[i] == (host, path, rule, verdict)


def test_trie_against_brute_force():
    rules = [("b.c/", "block"), ("b.c/x/", "allow"), ("a.b.c/x", "block"), ("c/xy/z", "allow"), ("b.c/x/y", "block"), ("c", "allow")]

    def brute(host, path):
        best = None
        for rule, verdict in rules:
            rhost, slash, tail = rule.partition("/")
            if (host == rhost or host.endswith("." + rhost)) and path.startswith(slash + tail):
                key = (rhost.count(".") + 1, len(slash + tail))
                if best is None or key > best[0]:
                    best = (key, (rule, verdict))
        return best and best[1]

    trie = url_filter.build_trie(rules)
    for host in ("", "c", "b.c", "a.b.c", "xb.c", "d.a.b.c"):
        for path in ("", "/", "/x", "/x/", "/x/y", "/x/yz/", "/xy/", "/xy/z1", "/xyz", "//"):
            assert url_filter.longest_match(trie, host, path) == brute(host, path), (host, path)


def test_too_many_rules_are_refused(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_RULES", 1)
    with pytest.raises(ValueError):
        url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"))


def test_license_of_whole_texts_and_lines(spark):
    mit = dict(license_scan.KNOWN)["MIT-0"]
    docs = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ;")),
        (2, "Some words.\nReleased under the MIT Licence!\nReleased  under the MIT license\nmore"),
        (3, "Licensed under the Apache Licence, v2.0"),
        (4, None), (5, ""), (6, "Copyright 2019 only"), (7, "released under the mit license of someone"),
        (2, "Some words.\nReleased under the MIT Licence!\nReleased  under the MIT license\nmore"), (None, "Licensed under CC BY 4.0."),
    ]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, license string")
    got = license_scan.scan(frame).collect()
    assert len(got) == len(docs)
    found = {(r["doc_id"], r["license"], r["line_licenses"], r["n_lines"]) for r in got}
    assert (1, "MIT-0", "MIT-0", 1) in found or (1, "MIT-0", None, 0) in found
    assert (2, None, "MIT", 2) in found and (3, "Apache-2.0", "Apache-2.0", 1) in found
    assert {(4, None, None, 0), (5, None, None, 0), (6, None, None, 0), (7, None, None, 0), (None, "CC-BY-4.0", "CC-BY-4.0", 1)} <= found
    assert license_scan.scan(frame.limit(0)).count() == 0
