import base64
import gzip
import glob
import hashlib
import math
import random
import re
from collections import Counter

import pytest
from conftest import rows
from odd_docs import make_docs, odd  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import privacy
from tidemark.llm.licenses import TEMPLATES, anchors, collision_probability, license_matches, plain_shingles, plain_words
from tidemark.llm.warc import ArcParser, CutShort, WarcParser, archive_pages, convert_arc, read_warc, revisits, write_arc, write_warc


def plain_licenses(pairs, containment=0.8):
    best = {}
    for doc_id, text in pairs:
        sh = plain_shingles(plain_words(text or ""))
        w = plain_words(text or "")
        all_sh = [" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        for name, template in TEMPLATES:
            t = plain_shingles(plain_words(template))
            share = max((len(set(t) & set(all_sh[k : k + len(t)])) / len(t) for k in range(max(1, len(all_sh) - len(t) + 1))), default=0)
            if sh and share >= containment:
                best[doc_id, name] = max(share, best.get((doc_id, name), 0))
    return sorted((d, n, round(c, 9)) for (d, n), c in best.items())


def test_licenses_equal_plain(make_docs, odd):  # noqa: F811
    rng = random.Random(7)
    pairs = [p for p in odd if p[0] is not None]
    for i in range(120):
        words = [f"w{rng.randrange(200)}" for _ in range(rng.randint(0, 80))]
        at = rng.randint(0, len(words))
        notice = rng.choice(TEMPLATES)[1]
        if i % 4 == 1:
            notice = notice.upper().replace(" ", "\n ")
        if i % 4 == 2 and len(notice) > 100:
            notice = notice.replace("software", "program", 1)
        pairs.append((100 + i, " ".join([*words[:at], notice, *words[at:]]) if i % 5 else " ".join(words)))
    got = {(r.doc_id, r.license): r.containment for r in license_matches(make_docs(pairs)).collect()}
    expected = {(d, n): share for d, n, share in plain_licenses(pairs)}
    assert len(expected) > 80 and expected.keys() <= got.keys()
    # Words up to the neighbouring windows count too, so a notice with words put in may hold more than in its best window.
    assert all(got[k] >= share - 1e-9 for k, share in expected.items()) and len(got) <= len(expected) + 2
    assert license_matches(make_docs(pairs).limit(0)).count() == 0
    assert license_matches(make_docs(pairs), templates=(("x", " !"),)).count() == 0


def test_notices_of_one_family_keep_their_names(make_docs):  # noqa: F811
    grant = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    tail = " This {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {}General Public License for more details."
    wanted = {1: {"GPL-2.0"}, 2: {"GPL-3.0"}, 3: {"LGPL-2.1"}, 4: {"LGPL-3.0"}, 5: {"AGPL-3.0"}}
    kinds = {1: ("program", ";", "", ";", "2"), 2: ("program", ":", "", ",", "3"), 3: ("library", ";", "Lesser ", ";", "2.1"), 4: ("program", ":", "Lesser ", ",", "3"), 5: ("program", ":", "Affero ", ",", "3")}
    texts = {i: "x y z " * 9 + grant.format(*k) + " a b c" * 9 for i, k in kinds.items()}
    texts |= {10 + i: "x y z " * 9 + grant.format(*k) + tail.format(k[0], k[2]) + " a b c" * 9 for i, k in kinds.items()}
    wanted |= {10 + i: w for i, w in wanted.items()}
    texts |= {30: f"{texts[1]} {texts[5]}", 31: f"{grant.format(*kinds[3])} {grant.format(*kinds[2])}"}
    wanted |= {30: {"GPL-2.0", "AGPL-3.0"}, 31: {"LGPL-2.1", "GPL-3.0"}}
    short = {"CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.", "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    texts |= {40 + i: f"one two {t} three four" for i, t in enumerate(short.values())}
    wanted |= {40 + i: {name} for i, name in enumerate(short)}
    got = {}
    for r in license_matches(make_docs([*texts.items(), (99, "no notice")])).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == wanted


def test_every_likely_window_has_an_anchor():
    shingles = [plain_shingles(plain_words(t)) for _, t in TEMPLATES]
    found = anchors(shingles, 0.8)
    for own in shingles:
        assert sum(not set(found) & set(s.split()) for s in own) < 0.8 * len(own)
    assert collision_probability(2 / 3, 16, 2) > 0.9999


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def private_texts():
    rng = random.Random(8)
    alphabet = ["a@b.c", "x.y%+z@d-e.f.g", "@", ".", "1", "25", "255", "256", "001.2.3.4", "1.2.3.4.5.6.7.8", "%q@w.e", " ", "-", "4539 1488 0343 6467", "4539148803436467", "45391488034364671", "+49 (030) 123-4567", "+1", "é", "𝔘", "\n", "a@b.c%d@e.f", "+4912345678901234567"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(800)]


def test_base_spans_equal_plain(make_docs, odd):  # noqa: F811
    pairs = list(odd) + [(100 + i, t) for i, t in enumerate(private_texts())]
    expected = []
    for doc_id, text in pairs:
        base = plain_base(text)
        n = Counter(k for k, _, _ in base)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        expected.append((doc_id, n["email"], n["ip"], n["card"], n["phone"], digest))
    got = privacy.report(privacy.personal_data(make_docs(pairs)))
    assert rows(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(expected, key=repr)
    assert privacy.report(privacy.personal_data(make_docs(pairs).limit(0))).count() == 0


def test_terms_that_give_an_entity_away(make_docs):  # noqa: F811
    pairs = [(i, f"the note {i} of Zanzibar Smith, mail zs@mail.org the end") for i in range(4)]
    pairs += [(10 + i, f"the note {i} without more of it the end") for i in range(40)]
    found = privacy.personal_data(make_docs(pairs))
    texts = dict(pairs)
    for r in found.collect():
        terms = {texts[r.doc_id][t.start : t.end] for t in r.terms}
        assert terms == ({"Zanzibar", "Smith", "mail"} if r.doc_id < 4 else set())
        assert all(t.ratio == pytest.approx(1) for t in r.terms)
    clean = found.join(make_docs(pairs).select("doc_id", "text"), "doc_id").select(
        "doc_id", privacy.sanitise(F.col("text"), F.col("base"), F.col("terms"), removal=1.1).alias("t"),
        privacy.sanitise(F.col("text"), F.col("base"), F.col("terms")).alias("u"))
    got = {r.doc_id: (r.t, r.u) for r in clean.collect()}
    assert got[1] == ("the note 1 of [TERM] [TERM], [TERM] [EMAIL] the end", "the note 1 of  ,  [EMAIL] the end")
    assert got[12][0] == texts[12]


def plain_terms(pairs, support=2, disclosure=0.9):
    word = re.compile(privacy_term)
    base = [sorted((a, b, f"{k}:{(text or '')[a:b].lower()}") for k, a, b in plain_base(text)) for _, text in pairs]
    places = [[(m.start(), m.end(), m.group().lower()) for m in word.finditer(text or "")] for _, text in pairs]
    free = [[p for p in own if not any(a < p[1] and p[0] < b for a, b, _ in spans)] for own, spans in zip(places, base)]
    df_term, df_entity, both = Counter(), Counter(), Counter()
    for own, out, spans in zip(places, free, base):
        entities, terms = {e for _, _, e in spans}, {t for _, _, t in out}
        df_term.update({t for _, _, t in own})
        df_entity.update(entities)
        both.update((e, t) for e in entities for t in terms)
    best = {}
    for (e, t), n in both.items():
        information = math.log2(len(pairs) / df_entity[e])
        ratio = math.log2(len(pairs) * n / (df_term[t] * df_entity[e])) / information if information else 0
        if n >= support and ratio >= disclosure - 1e-12:
            best[t] = max(ratio, best.get(t, 0))
    return {i: [(a, b, pytest.approx(best[t])) for a, b, t in out if t in best] for (i, _), out in zip(pairs, free)}


privacy_term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def test_terms_are_marked_everywhere(make_docs):  # noqa: F811
    rng = random.Random(11)
    fill = lambda n: " ".join(rng.choice("the of a note with more end so".split()) for _ in range(n))
    pairs = [(i, f"Zanzibar {fill(60)} mail: zs@mail.org-Ωx {fill(60)} ΖΑΝΖΙ漢字漢字 zanzibar") for i in range(30)]
    pairs += [(30, f"{fill(50)} ZANZIBAR {fill(5)}")]
    pairs += [(40 + i, f"kurz {'漢字' * 60} x+49 (030) 123-4567é {'漢字' * 60}, é a@b.c%d@e.f") for i in range(3)]
    pairs += [(50 + i, t) for i, t in enumerate(private_texts()[:300])]
    pairs += [(1000 + i, fill(20)) for i in range(300)]
    got = {r.doc_id: [tuple(t) for t in r.terms] for r in privacy.personal_data(make_docs(pairs)).collect()}
    assert got == plain_terms(pairs)
    assert [dict(pairs)[30][a:b] for a, b, _ in got[30]] == ["ZANZIBAR"]
    assert len(got[0]) == 5 and {dict(pairs)[40][a:b] for a, b, _ in got[40]} >= {"kurz"}


PAGES = [
    (3, "http://a/x y", "<p>same</p>"), (1, "http://b", "<p>same</p>"), (2, None, None), (4, "http://c", ""), (5, "http://d", "a\r\n\r\nb\r\n\r\n"),
    (6, "http://e", "\n\nGrüße\r\n"), (6, "http://e", "\n\nGrüße\r\n"), (None, "http://f", "<p>same</p>"), (7, "http://g", "x" * 300_000), (8, "http://h", "HTTP/1.1 404 No\r\n\r\n"),
]


def pages_of(spark, pages):
    return spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, record_id string").repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_pages_survive_both_archives(spark, least):
    got = archive_pages(pages_of(spark, PAGES), least).collect()
    assert len(got) == len(PAGES) and all(r.intact for r in got)
    assert Counter((r.page_id, r.target_uri) for r in got)[3, "http://a/x%20y"] == 1
    by_html = {}
    for page, _, html in PAGES:
        by_html.setdefault(html or "", []).append(page)
    for html, ids in by_html.items():
        payload = html.encode()
        own = [r for r in got if r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()]
        assert sorted((r.page_id for r in own), key=repr) == sorted(ids, key=repr) and {r.payload_bytes for r in own} == {len(payload)}
        first = min(i for i in ids if i is not None)
        again = [r for r in own if r.record_type == "revisit"]
        if len(payload) < least:
            assert not again
        else:
            assert len(again) == len(own) - 1 and all(r.refers_to == first for r in again)
            assert {r.refers_to_record for r in again} <= {r.record_id for r in own if r.record_type == "response"}
    assert archive_pages(pages_of(spark, PAGES).limit(0)).count() == 0


def test_written_files_are_archives(spark, tmp_path):
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    write_arc(pages_of(spark, PAGES), arc)
    versions, contents = set(), []
    for path in glob.glob(f"{arc}/*.gz"):
        parser = ArcParser()
        for header, content in parser.feed(gzip.open(path).read()):
            contents.append(content)
        versions.add(parser.version)
    assert versions == {1, 2} and sum(c.startswith(b"HTTP/1.1 200 OK\r\n") for c in contents) == len(PAGES)
    records = convert_arc(spark, arc)
    assert {r.type for r in records.select("type").collect()} == {"warcinfo", "response"}
    write_warc(records, revisits(records), warc)
    seen = Counter()
    for path in glob.glob(f"{warc}/*.gz"):
        for header, block in WarcParser().feed(gzip.open(path).read()):
            assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}>", header["warc-record-id"])
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", header["warc-date"])
            assert header["warc-block-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            seen[header["warc-type"]] += 1
    assert seen["response"] == 6 and seen["revisit"] == 4 and seen["warcinfo"] >= 1
    assert read_warc(spark, warc).count() == len(PAGES)


def test_legacy_records_of_both_versions():
    one = b"filedesc://a.arc 0.0.0.0 19990101000000 text/plain 74\n1 0 Some Archive\nURL IP-address Archive-date Content-type Archive-length\n\nhttp://u/a b 1.2.3.4 19991231235959 text/html 5\nab\ncd\n"
    two = b"filedesc://b.arc 0.0.0.0 19990101000000 text/plain 8\n2 0 Arc\n\nhttp://v 1.2.3.4 20010101000000 text/html 200 abc - 17 f.arc 3\n\n\n\n"
    first, second = list(ArcParser().feed(one)), list(ArcParser().feed(two))
    assert first[0][1].startswith(b"1 0") and first[1][0]["URL"] == "http://u/a b" and first[1][1] == b"ab\ncd"
    assert second[1][0]["Checksum"] == "abc" and second[1][0]["Offset"] == "17" and second[1][1] == b"\n\n\n"
    with pytest.raises(ValueError):
        list(ArcParser().feed(b"no header at all\n"))


ARC = b"filedesc://a.arc 0.0.0.0 19990101000000 text/plain 74\n1 0 Some Archive\nURL IP-address Archive-date Content-type Archive-length\n\n"
PAGE = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nsame payload\r\n\r\n"


def arc_of(*pages):
    return ARC + b"".join(b"http://u 1.2.3.4 19991231235959 text/html %d\n%s\n" % (len(p), p) for p in pages)


def test_records_cut_short_are_errors(spark, tmp_path):
    whole = arc_of(PAGE, PAGE[:-4])
    assert len(list(ArcParser().feed(whole))) == 3
    for cut in (1, 2, 4, 5, 30, 50, 80):
        parser = ArcParser()
        list(parser.feed(whole[: -cut]))
        if cut == 1:  # the line end after the last record
            parser.finish()
        else:
            with pytest.raises(CutShort):
                parser.finish()
    path = tmp_path / "cut" / "a.arc.gz"
    path.parent.mkdir()
    path.write_bytes(gzip.compress(whole[:-5]))
    with pytest.raises(Exception, match="a.arc.gz: the last record is cut short"):
        convert_arc(spark, str(path.parent)).collect()
    warc = str(tmp_path / "warc")
    path.write_bytes(gzip.compress(whole))
    write_warc(convert_arc(spark, str(path.parent)).coalesce(1), revisits(convert_arc(spark, str(path.parent))), warc)
    [part] = [p for p in glob.glob(f"{warc}/*.gz") if len(gzip.open(p).read())]
    assert read_warc(spark, warc).count() == 2
    short = tmp_path / "short"
    short.mkdir()
    (short / "b.warc.gz").write_bytes(gzip.compress(gzip.open(part).read()[:-9]))
    with pytest.raises(Exception, match="b.warc.gz: the last record is cut short"):
        read_warc(spark, str(short)).collect()


def test_archives_of_one_name_do_not_clash(spark, tmp_path):
    folders = []
    for name in ("one", "two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.arc.gz").write_bytes(gzip.compress(arc_of(PAGE, PAGE)))
        folders.append(str(tmp_path / name))
    records = convert_arc(spark, folders).coalesce(1)
    ids = [r.record_id for r in records.collect()]
    assert len(ids) == 6 == len(set(ids))
    assert rows(records.filter("type = 'response'"), "page_id", "payload_bytes") == [(4, 16)] * 4
    again = revisits(records).collect()
    assert len(again) == 3 and len({r["first"]["record_id"] for r in again}) == 1


def test_places_of_many_matches(make_docs):
    """Strides of matches join without a seam, and a text with very many of them is no hurdle."""
    texts = {n: " ".join(f"é{i} u{i}@ex.org" for i in range(n)) for n in (0, 1, 255, 256, 257, 1030, 20_000)}
    got = {r.doc_id: r.base for r in privacy.personal_data(make_docs(list(texts.items()))).select("doc_id", "base").collect()}
    for n, text in texts.items():
        assert [(b.start, b.end) for b in got[n]] == [m.span() for m in re.finditer(r"u\d+@ex\.org", text)]
