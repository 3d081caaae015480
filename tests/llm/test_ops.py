"""Each operator against a plain version, on awkward rows: nulls, empty and long texts, ties, repeats, extra columns."""

import hashlib
import itertools
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from brindle.llm import bpe, bwt, common, covertree, gif, langid, licenses, minhash, pack, pii, queries, suffix, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, d string"


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "é", "ß", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    passage = words(rng, 150)
    texts = [None, "", " ", "a", "One two", "one TWO", base, base, " ".join(near), words(rng, 4000), passage + words(rng, 30), words(rng, 20) + passage, "ab " * 600, "x" * 3000, "mail a@b.example.com or +1 (269) 555-3296 or 4111111111111111 or 10.1.2.3", "Released under the MIT License.\nMIT license mit license", "'tis we'll 12 345\n\n  end  ", base.upper()]
    return [(None if i == 3 else i, t, "en" if i % 2 else None, None, None, "clash", "clash") for i, t in enumerate(texts)] + [(7, base, "en", None, None, "clash", "clash")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_gif_known_stream():
    # the well-known ten by ten sample image
    codes = bytes.fromhex("8C2D99872A1CDC33A00275EC95FAA8DE608C04914C01")
    pixels = gif.lzw_decode(codes, 2, 100)
    assert pixels[:10] == bytes([1, 1, 1, 1, 1, 2, 2, 2, 2, 2]) and len(pixels) == 100


def test_gif_compose():
    def image(left, top, w, h, data, transparent=None, disposal=0, delay=0):
        flags = disposal << 2 | (transparent is not None)
        return b"\x21\xf9\x04" + bytes([flags, delay, 0, transparent or 0]) + b"\0\x2c" + b"".join(x.to_bytes(2, "little") for x in (left, top, w, h)) + b"\0\x02" + gif._blocks(gif.lzw_encode(bytes(data), 2)) + b""

    head = b"GIF89a" + bytes([2, 0, 2, 0, 0x81, 0, 0]) + bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    found = gif.frames(head + image(0, 0, 2, 2, [1, 1, 1, 1], delay=3) + image(1, 1, 1, 1, [2], disposal=3) + image(0, 0, 2, 1, [0, 3], transparent=0, disposal=2) + image(0, 1, 1, 1, [2]) + b";")["frames"]
    assert [f["delay_cs"] for f in found] == [3, 0, 0, 0]
    colour = lambda k: found[k]["canvas"][..., :3].reshape(-1, 3).argmax(1).tolist()
    assert colour(1) == [0, 0, 0, 1] and colour(2) == [0, 2, 0, 0]  # restored, then drawn through a hole
    assert found[3]["canvas"][0, :, 3].tolist() == [0, 0] and found[3]["canvas"][1, 0, 1] == 255  # cleared, then drawn


def plain_gif(media):
    """An independent reader, a bit at a time, for files with one palette: (delay, top, rows of pixels' colours)."""
    at = 13 + 3 * 2 ** ((media[10] & 7) + 1)
    palette = [tuple(media[13 + 3 * i : 16 + 3 * i]) for i in range((at - 13) // 3)]
    delay, out = 0, []
    while media[at] != 0x3B:
        if media[at] == 0x21:
            delay, at = int.from_bytes(media[at + 4 : at + 6], "little"), at + 8
            continue
        left, top, w, h = (int.from_bytes(media[at + k : at + k + 2], "little") for k in (1, 3, 5, 7))
        size, at, data = media[at + 10], at + 11, b""
        while media[at]:
            data, at = data + media[at + 1 : at + 1 + media[at]], at + 1 + media[at]
        at += 1
        bits, pos = int.from_bytes(data, "little"), 0
        table, width, old, pixels = {}, size + 1, None, []
        while True:
            code, bits, pos = bits & (1 << width) - 1, bits >> width, pos + width
            if code == 1 << size:
                table, width, old = {i: [i] for i in range(1 << size)}, size + 1, None
                continue
            if code == (1 << size) + 1:
                break
            new = table[code] if code in table else old + old[:1]
            pixels += new
            if old is not None and len(table) + 2 < 4096:
                table[len(table) + 2] = old + new[:1]
                if len(table) + 2 == 1 << width and width < 12:
                    width += 1
            old = new
        assert len(pixels) == w * h and left == 0
        out.append((delay, top, [palette[p] for p in pixels]))
    return out


def test_gif_store(docs, rows, empty):
    got = gif.store_texts(docs, rows=40).collect()  # several frames
    assert len(got) == len(rows) and gif.store_texts(empty).count() == 0
    want = Counter()
    for i, t, *_ in rows:
        raw = (t or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        media = gif.encode_samples(payload, rows=40)
        read = plain_gif(media)
        assert bytes(p[0] for _, _, pixels in read for p in pixels) == payload
        # what a frame shows: its rows, and below them those of the frame before
        shown, total = [], Counter()
        for _, _, pixels in read:
            shown = pixels + shown[len(pixels) :]
            total.update(16 * (r // 64) + 4 * (g // 64) + b // 64 for r, g, b in shown)
        feature = "rgb64:" + ",".join(f"{k}={n}" for k, n in sorted(total.items()))
        want[i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(read), sum(d for d, *_ in read)] += 1
    assert Counter(tuple(r)[:10] for r in got) == want
    assert all([f["start_cs"] for f in json.loads(r.frames)] == [4 * k for k in range(r.n_frames)] for r in got)
    broken = docs.sparkSession.createDataFrame([(1, b"no gif"), (2, None), (3, gif.encode_samples(b"ab" * 32))], "doc_id long, media binary")
    assert {(r.doc_id, r.error is None, r.frame) for r in gif.media_frames(broken).collect()} == {(1, False, None), (2, False, None), (3, True, 0)}


def test_licenses(docs, rows, empty):
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows) and licenses.scan(empty).count() == 0
    r = next(r for r in got if r.doc_id == 15)
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.score) == (9, 3, 3, 7, "mit", 1.0)
    assert all(r.labels == "" and r.score == 0 and r.first_word is None for r in got if r.doc_id != 15)


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction"
BSD = " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met:\n *"


def labelled(spark, texts):
    return {r.doc_id: (r.labels, r.n_spans) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}


def test_licenses_wrapped(spark):
    """Over line ends, blank lines and comment signs; nothing for tokens that lie apart."""
    isc = "Permission to use, copy, modify, and/or distribute this software for any\r\npurpose with or without fee is hereby granted, provided that"
    gpl = "This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation"
    texts = [f"One line.\n\n{MIT}.\n\nThe end.", BSD, isc, MIT.replace("\n", "\n\n"), f"{MIT}\n\n{BSD}\n{BSD}", "All rights reserved.\nof all rights\n\nreserved", gpl, "MIT Li\u212aense \u0130 mit license"]
    texts += ["all " + "x " * 200 + "rights " + "x " * 200 + "reserved", "rights of all that are reserved", " ".join(f"x {w}" for w in MIT.split())]
    got = {k: v[0] for k, v in labelled(spark, texts).items()}
    assert got == {0: "mit", 1: "bsd", 2: "isc", 3: "mit", 4: "bsd,mit", 5: "proprietary", 6: "gpl", 7: "mit", 8: "", 9: "", 10: ""}


def test_licenses_give_way(spark):
    """A restricted or other license is not taken for the one that its words also hold; side by side both are found."""
    boost = "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\")"
    texts = ["Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.", "CC BY-NC-SA 4.0", boost, f"{boost} {MIT}", "CC BY-ND 4.0 or, as said below, and for other works than those named above, CC BY 4.0.", "Creative Commons Attribution-NonCommercial-NoDerivatives", "under the GNU Lesser General Public License"]
    got = {k: v[0] for k, v in labelled(spark, texts).items()}
    assert got == {0: "cc-by", 1: "cc-by-nc", 2: "cc-by-nc-sa", 3: "boost", 4: "boost,mit", 5: "cc-by,cc-by-nd", 6: "cc-by-nc-nd", 7: "gpl,lgpl"}


def test_licenses_by_name(spark):
    names = {"MIT": "mit", "Apache-2.0": "apache", "GPL-3.0-or-later": "gpl", "LGPL-2.1-only": "lgpl", "BSD-3-Clause": "bsd", "CC0-1.0": "cc0", "CC-BY-SA-4.0": "cc-by-sa", "BSL-1.0": "boost", "Unlicense": "unlicense", "None": ""}
    got = labelled(spark, [f"// SPDX-License-Identifier: {n}\nint main" for n in names])
    assert [got[k][0] for k in range(len(names))] == list(names.values())
    assert [v[0] for _, v in sorted(labelled(spark, ["the ISC License", "BSD 2-Clause", "Mozilla Public License", "public domain"]).items())] == ["isc", "bsd", "mpl", ""]


def test_licenses_against_all_spans(spark):
    """Every span compared with every template, at random places of longer texts, around the ends of stretches."""
    rng = random.Random(21)
    templates = licenses.template_tokens()
    common_words = sorted({t for _, tokens, _ in templates for t in tokens})
    texts = []
    for k in range(60):
        w = [rng.choice(common_words if rng.random() < 0.3 else ["x", "y", "zz"]) for _ in range(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            notice = re.findall(licenses.WORD, rng.choice(licenses.TEMPLATES)[1].lower())
            at = rng.choice([rng.randint(0, len(w)), max(0, min(len(w), 64 * rng.randint(0, 4) - rng.randint(0, 30)))])
            w[at:at] = [x for x in notice if rng.random() < 0.97]
        texts.append(" ".join(w))

    def plain(w):
        found = []
        for label, tokens, span in templates:
            need = licenses.needed(len(tokens))
            for s, x in enumerate(w):
                if x in tokens and len(has := {y for y in w[s : s + span] if y in tokens}) >= need:
                    end = max(s + i for i, y in enumerate(w[s : s + span]) if y in tokens)
                    found.append((label, set(tokens), s, end, has, len(has) / len(tokens)))
        left = [t for t in found if not any((u[5] > t[5] or (u[5] == t[5] and len(u[1]) > len(t[1]))) and u[2] <= t[3] and t[2] <= u[3] and t[4] <= u[1] for u in found)]
        return {t[0] for t in left}, len(left), max((t[5] for t in left), default=0.0)

    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    hits = 0
    for k, text in enumerate(texts):
        labels, n, score = plain(text.split())
        r = got[k]
        base = set(r.base_labels.split(",")) - {""}
        assert (set(r.labels.split(",")) - {""}, r.n_spans) == (labels | base, n) and (r.score == 1.0 if base else r.score == pytest.approx(score))
        hits += n
    assert hits > 80


def test_pii_base():
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice("ab1.@-+ é(") for _ in range(rng.randint(0, 40)))
        assert pii.emails(t) == [m.span() for m in plain.finditer(t)]
    assert pii.base_spans("1.2.3.4.5.6.7.8 or 1.2.3.999 or +1 (269) 555-3296 or 4111 1111 1111 1111") == [("ip", 0, 7), ("ip", 8, 15), ("card", 53, 72), ("phone", 32, 49)]
    assert pii.base_spans("9" * 200_000 + "a" * 200_000 + "@") == []  # long runs are read once


def plain_base(text):
    """The four base kinds by their patterns, left to right, and checks written out."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m[0].split("."))) <= 255:
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c not in " -"]
        if 13 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_brute_force(spark):
    rng = random.Random(12)
    bits = ["a.b@c.de", "@", "x@y", "10.0.0.1", "1.2.3.4.5", "999.1.1.1", "0010.2.3.4", "4111111111111111", "4111 1111-1111 1111", "1234567890123", "+1 (269) 555-3296", "+49.30.123456", "+1", " ", " ", ".", "-", "é", "word", "7", "😀", "٣", "+12345678901234567890"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    assert [pii.base_spans(t) for t in texts] == [plain_base(t) for t in texts]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, spans string, found string")
    for r in pii.report(df).collect():
        base = plain_base(texts[r.doc_id])
        kinds = Counter(k for k, *_ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.BASE_KINDS)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r.spans.split(",")) and r.n_spans - r.n_added == len(base)


def test_pii_adds(spark):
    rng = random.Random(3)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f"{words(rng, 30)} token = \"{hexes()}\" {words(rng, 5)}") for i in range(40)]
    rows += [(100 + i, f"{words(rng, 20)} {rng.randint(10**15, 10**16 - 1)} {words(rng, 5)}") for i in range(40)]
    rows += [(200 + i, words(rng, 60)) for i in range(40)] + [(300, "chapter 12, version 3.1, in 2024 and 1999; key = value; token: none"), (301, "x@ y (at) z")]
    rows += [(400, "api_key: 'sk-abcDEF0123456789abcDEF01'"), (401, "call +1 (826) 555-4081 190.137.223.20 now")]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].spans.startswith("secret:") for i in range(40)) and all(got[100 + i].n_spans == 1 for i in range(40))
    assert all(got[i].n_spans == 0 for i in [*range(200, 240), 300])
    assert got[400].spans.startswith("secret:10:") and got[401].n_added >= 1


def test_pii(docs, rows, empty):
    got = pii.report(docs).collect()
    assert len(got) == len(rows) and pii.report(empty).count() == 0
    r = next(r for r in got if r.doc_id == 14)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1) and r.spans.startswith("email:5:20,ip:")
    assert all(r.spans == "" for r in got if r.doc_id != 14)
    text = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert text[14] == "mail [EMAIL] or [PHONE] or [CARD] or [IP]" and text[0] is None and text[1] == ""


def plain_groups(rows):
    return Counter(plain_list(rows))


def plain_list(rows):
    sets = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (k, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((k, len(sets[i]), min(ids, default=None)))
    return out


def test_minhash(docs, rows, empty):
    got = minhash.groups(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_groups(rows)
    assert minhash.groups(empty).count() == 0
    kept = minhash.deduplicated(docs)
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    stays = [n == 0 or c is None or i == c for i, n, c in plain_list(rows)]
    assert kept.columns == docs.columns and found == Counter((i, t) for (i, t, *_), s in zip(rows, stays) if s)


def test_minhash_deduplicated_by_row(spark):
    base, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, base, "x"), (None, base, "x"), (5, base, "y"), (5, other, "z"), (6, other, "x"), (None, "alone", "x"), (7, None, "x"), (7, None, "x"), (1, base, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, t1 string")
    assert Counter(tuple(r) for r in minhash.deduplicated(df).collect()) == Counter([(1, base, "x"), (1, base, "again"), (5, other, "z"), (None, "alone", "x"), (7, None, "x"), (7, None, "x")])


@pytest.mark.parametrize("edits,small", [((0, 1, 1, 2, 3), minhash.SMALL), ((2, 3, 4, 5), 2)])
def test_minhash_large_group(spark, monkeypatch, edits, small):
    monkeypatch.setattr(minhash, "SMALL", small)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        w = list(base)
        for k in rng.sample(range(60), rng.choice(edits)):
            w[k] = f"z{rng.randint(0, 5)}"
        rows.append((i, " ".join(w)))
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_groups(rows)


def test_odd_sketch_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    for share in (1.0, 0.95, 0.85):
        n = int(2000 * 2 * share / (1 + share))
        b = np.concatenate([a[:n], rng.integers(0, 1 << 63, 2000 - n).astype(np.uint64)])
        x = minhash.odd_sketch(minhash.minhash(a)) ^ minhash.odd_sketch(minhash.minhash(b))
        bits = sum(int(v).bit_count() for v in x.view(np.uint64))
        assert abs(minhash.sketched_similarity(bits) - share) < 0.08


def test_language(spark, docs, rows, empty):
    rng = random.Random(1)
    syllables = {"en": ["th", "ing", "er", "wh"], "de": ["sch", "ung", "ü", "ei"], "es": ["ción", "ñ", "os", "ll"], "fr": ["eau", "é", "oi", "ç"]}
    data = [(i, " ".join("".join(rng.choice(syllables[k]) for _ in range(3)) for _ in range(20)), k) for i, k in enumerate(sorted(syllables) * 60)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = langid.train(df.where(~langid.held_out()))
    assert set(model.families) == {"germanic", "romance"}
    truth = {i: k for i, _, k in data}
    held = [r for r in langid.identify(df.where(langid.held_out()), model).collect()]
    assert held and sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows) and all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (0, 1, 2))
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(docs, langid.train(empty)).where("lang_pred = 'und'").count() == len(rows)


def test_language_kept(spark):
    rng = random.Random(1)
    syllables = {"en": ["th", "ing", "er", "wh"], "de": ["sch", "ung", "ü", "ei"], "es": ["ción", "ñ", "os", "ll"], "fr": ["eau", "é", "oi", "ç"]}
    text = lambda k, n: " ".join("".join(rng.choice(syllables[k]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(k, 40), k, "x") for i, k in enumerate(sorted(syllables) * 40)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, known string"))
    new = [(1, text("en", 30), "kept"), (2, text("fr", 1), "kept"), (3, text("de", 3).upper(), "kept"), (3, text("es", 300), "kept"), (4, "to jest zdanie w języku polskim, którego model nie zna wcale", "gone"), (5, "это предложение", "gone"), (6, "xq zkj vbw qqx jjk zxv kqp wvx", "gone"), (7, None, "gone"), (8, "12 !", "gone"), (9, "", "gone"), (None, text("en", 5), "kept"), (None, text("en", 5), "kept")]
    df = spark.createDataFrame(new, "doc_id long, text string, known string")
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and Counter(map(tuple, kept.collect())) == Counter(r for r in new if r[2] == "kept")
    assert langid.keep_identified(df.limit(0), model).count() == 0


def test_language_sample_is_bounded(spark):
    """Copies of one text count once, and the rows that reach the driver are bounded whatever the table."""
    rows = [(i, "boilerplate text", "en") for i in range(3000)] + [(i, f"ein satz {chr(97 + i % 26)}{i}", "de") for i in range(300)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_rows=40)
    assert model.predict("boilerplate text")[0] == "en" and model.predict("ein satz b")[0] == "de"


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken"])
def test_bpe_like_the_library(name):
    import tiktoken

    model = bpe.load(public_tokenizers.path(name))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})
    rng = random.Random(3)
    signs = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "é", "1", "½", "!", "\xa0", "　", "😀", "日本", "L", "́", "\x85"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 150))) for _ in range(400)] + ["ab" * 3000, "x" * 500]
    for t, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(t) and model.decode(ids) == t.encode()
        assert model.offsets(ids)[-1] == len(t.encode())


def test_bpe(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = bpe.round_trip(docs, path).collect()
    want = Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.decoded_sha256) for r in got) == want and bpe.round_trip(empty, path).count() == 0
    back = bpe.decode(bpe.encode(docs, path), path).collect()
    assert Counter((r.doc_id, hashlib.sha256(r.text_bytes).hexdigest()) for r in back) == want


def test_cover_tree(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=8) * 0.12], i % 3) for i in range(300)]
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(5)] + [(400, None, 1), (401, [0.0] * 8, 1), (402, [float("nan")] * 8, 1), (403, rows[1][1], None), (None, rows[2][1], rows[2][2]), (404, [], 0), (405, [1.0, None], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ok = lambda v: v and None not in v and np.isfinite(v).all() and any(v)
    usable = [i for i, (_, v, k) in enumerate(rows) if k is not None and ok(v)]
    n, parent = Counter(), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(usable, 2):
        a, b = np.array(rows[i][1]), np.array(rows[j][1])
        if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
            n[i] += 1
            n[j] += 1
            parent[max(find(i), find(j))] = min(find(i), find(j))
    want = Counter()
    for i, (k, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        want[k, n[i], min(ids)] += 1
    for block, per in ((covertree.BLOCK, covertree.CELL_POINTS), (40, 30)):
        covertree.BLOCK, covertree.CELL_POINTS, before = block, per, (covertree.BLOCK, covertree.CELL_POINTS)
        try:
            got = covertree.links(df).collect()
        finally:
            covertree.BLOCK, covertree.CELL_POINTS = before
        assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert covertree.links(df.limit(0)).count() == 0


def plain_svm(x, sign, c=10.0):
    """The same problem by Newton steps on the rows that are within the margin, in the space that the rows span."""
    q, _ = np.linalg.qr(x.T.astype(float))
    z = np.hstack([x @ q, np.ones((len(x), 1))])
    weight = np.where(sign > 0, 0.5 / (sign > 0).sum(), 0.5 / (sign < 0).sum()) * c
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-9
    loss = lambda w: 0.5 * w[:-1] @ w[:-1] + (weight * np.maximum(0, 1 - sign * (z @ w)) ** 2).sum()
    w = np.zeros(z.shape[1])
    for _ in range(100):
        inside = sign * (z @ w) < 1
        zi, wi = z[inside], weight[inside]
        goal = np.linalg.solve(ridge + 2 * zi.T @ (wi[:, None] * zi), 2 * zi.T @ (wi * sign[inside]))
        step = 1.0
        while step > 1e-6 and loss(w + step * (goal - w)) > loss(w):
            step /= 2
        if np.abs(step * (goal - w)).max() < 1e-10:
            break
        w = w + step * (goal - w)
    return np.append(q @ w[:-1], w[-1])


def plain_features(text):
    low = f" {text.lower()} "
    signs = [c if c.isalpha() else " " for c in low]
    if not any(c != " " for c in signs):
        return None
    x, wrap = np.zeros(langid.BUCKETS), (1 << 32) - 1
    for i in range(len(signs) - 1):
        a, b = ord(signs[i]), ord(signs[i + 1])
        pair = (a * 2654435761 & wrap) ^ (b * 2246822519 & wrap)
        if (a, b) != (32, 32):
            x[(pair * 374761393 & wrap) >> 20] += 1
        if i + 2 < len(signs) and b != 32:
            triple = (pair * 3266489917 & wrap) ^ (ord(signs[i + 2]) * 668265263 & wrap)
            x[(triple * 374761393 & wrap) >> 20] += 1
    return np.sqrt(x) / np.sqrt(x.sum())


def test_language_against_another_solver(spark):
    """Features sign by sign, the machines by Newton's method: decisions are equal wherever the margin is clear."""
    rng = random.Random(31)
    stems = {"de": ["sch", "ung", "der", "ein", "ich"], "nl": ["aan", "ijk", "het", "een", "sch"], "fr": ["eau", "tion", "les", "oi", "que"], "es": ["cion", "los", "que", "ado", "ll"], "pl": ["szcz", "nie", "owa", "rz"]}
    text = lambda lang, n: " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = [(i, text(lang, rng.randint(8, 40)), lang) for i, lang in enumerate(sorted(stems) * 24)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7))
    x = np.array([plain_features(t) for _, t, _ in rows])
    langs = np.array([lang for *_, lang in rows])
    names = list(model.families)
    assert sorted(names) == ["germanic", "romance", "slavic"]
    top = {f: plain_svm(x, np.where([langid.family(v) == f for v in langs], 1.0, -1.0)) for f in names}
    pairs = {k: plain_svm(x[(langs == k[0]) | (langs == k[1])], np.where(langs[(langs == k[0]) | (langs == k[1])] == k[0], 1.0, -1.0)) for k in model.pairs}
    assert set(pairs) == {("de", "nl"), ("es", "fr")}
    clear = 0
    for k in range(150):
        t = text(rng.choice(sorted(stems)), rng.randint(2, 12))
        v = plain_features(t)
        assert np.allclose(v, langid.features(t), atol=1e-6)
        margins = sorted(((w[:-1] @ v + w[-1], f) for f, w in top.items()), reverse=True)
        family = margins[0][1]
        mine, least = model.families[family][0], margins[0][0] - margins[1][0]
        if len(model.families[family]) > 1:
            a, b = model.families[family]
            d = pairs[a, b][:-1] @ v + pairs[a, b][-1]
            mine, least = (a if d > 0 else b), min(least, abs(d))
        if least > 0.1:
            clear += 1
            assert model.predict(t)[0] == mine
    assert clear > 100
    # every triple of the training is remembered, in however many batches it came
    assert all(model.known(t, 0.0) and model.seen[langid._grams(t)[1] >> np.uint32(14)].all() for _, t, _ in rows)


def test_pack(spark, docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    rows = rows + [(100 + k, x, None, None, None, "", "") for k, x in enumerate(["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", " <|endoftext|>'s", "x <|endoftext|>\n" * 900])]
    docs = docs.unionAll(spark.createDataFrame(rows[-5:], SCHEMA))
    want = Counter()
    for i, x, *_ in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 2048):
            want[i, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes()), len(ids)] += 1
    got = pack.packed(docs, path).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [0, *itertools.accumulate(n for _, n in s)][:-1] and sum(n for _, n in s) <= 2048
    assert pack.packed(empty, path).count() == 0


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(0)
    h = Counter((-(-rng.integers(1, 2048, 20_000) // 8)).tolist())
    found = pack.plan(h)
    assert Counter({b: sum(p.get(b, 0) * n for p, n in found) for b in h}) >= Counter(h)
    assert all(sum(b * c for b, c in p.items()) <= 256 for p, _ in found)
    assert sum(n for _, n in found) <= 1.02 * sum(b * n for b, n in h.items()) / 256


def test_bwt():
    rng = random.Random(5)
    for _ in range(60):
        some = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 7))]
        _, lcp, who, start = bwt.build(*bwt.joined(some), spill_bytes=rng.choice([0, 1 << 20]))
        order = [some[i][j:] for i, j in zip(who, start)]
        assert order == sorted(order) and len(order) == sum(len(s) + 1 for s in some)
        common_ = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in itertools.pairwise(order)]
        assert lcp.tolist() == common_


def plain_removals(rows):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    counts, shorter = (Counter(b[k : k + n] for _, b in texts for k in range(len(b) - n + 1)) for n in (400, 240))
    out = Counter()
    for i, b in texts:
        short = bytearray(len(b))
        for k in range(len(b) - 239):
            if shorter[b[k : k + 240]] > 1:
                short[k : k + 240] = b"\1" * 240
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if counts[b[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest(), sum(short)] += 1
    return out


@pytest.mark.parametrize("hot,spill", [(suffix.HOT, suffix.SPILL), (1, 16)])
def test_suffix(docs, rows, empty, hot, spill, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "SPILL", spill)
    got = suffix.report(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passage_bytes) for r in got) == plain_removals(rows)
    assert suffix.report(empty).count() == 0
    names = ["d", "c", "kept", "_d", "x"]
    clash = docs.drop("d", "node").selectExpr("*", *(f"'{n}' AS {n}" for n in names))
    cleaned = suffix.cleaned(clash).collect()
    assert list(cleaned[0].asDict()) == clash.columns and len(cleaned) == len(rows) and {tuple(r[n] for n in names) for r in cleaned} == {tuple(names)}
    texts = {i: t for i, t, *_ in rows}
    assert all(r.text == texts[r.doc_id] for r in cleaned if r.doc_id in (0, 1, 2, 4, 9, 14, 15, 16))


@pytest.mark.parametrize("hot", [suffix.HOT, 3])
def test_suffix_planted(spark, hot, monkeypatch):
    """Passages of 300 to 500 bytes in many surroundings, near one another, at texts' ends and broken by single bytes."""
    monkeypatch.setattr(suffix, "HOT", hot)
    rng = random.Random(11)
    passages = [words(rng, 140)[:n] for n in (300, 390, 399, 400, 401, 415, 431, 433, 470, 500)]
    texts = []
    for k in range(120):
        some = rng.sample(passages, rng.randint(0, 3))
        parts = [p if rng.random() < 0.8 else p[:200] + "#" + p[201:] for p in some]
        texts.append("".join(x for p in parts for x in (words(rng, rng.randint(0, 6)), p)) + (words(rng, rng.randint(0, 3)) if k % 3 else ""))
    texts += [passages[-1][i:] + str(i) for i in range(60)] + ["ab" * 300 + str(i % 7) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = suffix.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passage_bytes) for r in got) == plain_removals(rows)


def test_suffix_names(spark):
    names, name = suffix._named(spark.createDataFrame([(1, 5, 1), (2, 5, 2), (3, 6, 1), (4, 6, 1)], "doc_id long, t1 long, t2 long"))
    got = names.select("t1", "t2", "copies", name(names["t1"], names["t2"])).collect()
    assert sorted(map(tuple, got)) == [(5, 1, 1, 1), (5, 2, 1, 2), (6, 1, 2, 6)]


def test_warc(spark):
    rows = [(1, "http://a\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "v", ""), (5, "w", "é" * 9000), (None, "n", "alone"), (7, "r", "twice"), (7, "r", "twice")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.parse_records(warc.read_archive(*warc.write_archive(df))).collect()
    assert len(records) == len(rows)
    by_id = {r.page_id: r for r in records}
    assert [by_id[k].record_type for k in (1, 2, 3, 4, 5)] == ["revisit", "response", "revisit", "response", "response"]
    assert by_id[1].refers_to_id == "<urn:page:2>" and by_id[1].block == b"" and by_id[1].payload == b"same"
    assert all(r.payload_digest == warc.sha1_base32(bytes(r.payload)) for r in records)
    assert sorted(r.record_type for r in records if r.page_id == 7) == ["response", "revisit"]
    joined = b"".join(bytes(r.record) for r in records)
    assert Counter(warc.split_warc(joined)) == Counter(bytes(r.record) for r in records)
    assert warc.read_archive(*warc.write_archive(df.limit(0))).count() == 0


def test_clashing_columns(spark):
    """Extra columns that have the operators' own names change nothing."""
    vectors = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [0.0, 1.0], 0), (3, [0.0, 1.0], 0)]
    plain = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    names = ["point", "vector", "copies", "cell", "own", "component", "n_links", "i", "j"]
    clash = plain.selectExpr("*", *(f"'x' AS {n}" for n in names))
    assert Counter(map(tuple, covertree.links(clash).collect())) == Counter(map(tuple, covertree.links(plain).collect())) == Counter({(1, 1, 1, True): 1, (2, 1, 1, False): 1, (3, 1, 3, True): 2})
    pages = spark.createDataFrame([(1, "u", "same"), (2, "v", "same"), (3, "w", None)], "page_id long, url string, html string")
    clash = pages.selectExpr("*", *(f"'x' AS {n}" for n in ("sha256", "payload", "header", "salt", "salts", "pick", "n", "uri", "record")))
    read = lambda df: Counter((r.page_id, bytes(r.record), bytes(r.payload), r.sha256) for r in warc.read_archive(*warc.write_archive(df)).collect())
    assert read(clash) == read(pages) and sum(read(clash).values()) == 3
    texts = spark.createDataFrame([(1, "MIT License", "x"), (None, "x@y.de", "x")], "doc_id long, text string, row string").selectExpr("*", *(f"'x' AS {n}" for n in ("stretch", "hits", "found", "spans", "rest", "bin", "bucket", "crcs", "media", "frames")))
    assert {r.labels for r in licenses.scan(texts).collect()} == {"mit", ""} and {r.n_email for r in pii.report(texts).collect()} == {0, 1}
    assert gif.store_texts(texts).count() == 2 and pack.packed(texts, public_tokenizers.path("byte_bpe_50k.json")).count() == 2


def test_warc_files(spark, tmp_path):
    import gzip

    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record * 2)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record))
    (tmp_path / "c.warc").write_bytes(b"")
    got = warc.parse_records(warc.read_warc_files(spark, str(tmp_path))).collect()
    assert sorted((r.path.rsplit("/", 1)[-1], r.position) for r in got) == [("a.warc", 0), ("a.warc", 1), ("b.warc.gz", 0)]
    assert all(bytes(r.record) == record and bytes(r.block) == b"abc" and r.record_type == "response" for r in got)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = list(range(500))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {i: got.get(i, i) for i in range(500)} == {i: find(i) for i in range(500)}


def test_registered():
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES] == list(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_cover_extreme_magnitudes(spark):
    """Components from the smallest to nearly the largest double, against exact arithmetic."""
    from fractions import Fraction

    rng = random.Random(12)
    vectors = [[1e200, 0.0], [0.0, 1e200], [1e200, 1e199], [1.0, 0.0], [5e-324, 0.0], [5e-324, 5e-324], [0.0, 5e-324], [1e300, 1e-300], [1.7e308, 1.7e308], [1e-160, 1e-161], [-1e300, 0.0], [1e-300, -1e-301], [2.0, 0.0], [0.5, 0.0]]
    vectors += [[rng.uniform(-1, 1) * 10.0 ** (e := rng.choice([-320, -300, -150, 0, 150, 300])), rng.uniform(-1, 1) * 10.0**e] for _ in range(60)]
    vectors = [v for v in vectors if any(v)]

    def linked(a, b):
        a, b = [Fraction(x) for x in a], [Fraction(x) for x in b]
        dot, norms = sum(x * y for x, y in zip(a, b)), sum(x * x for x in a) * sum(x * x for x in b)
        share = float(dot * dot / norms)
        assert abs(share - 0.98**2) > 1e-9
        return dot > 0 and share >= 0.98**2

    near = {i: {j for j in range(len(vectors)) if j != i and linked(vectors[i], vectors[j])} for i in range(len(vectors))}
    reach = {}
    for i in near:
        todo, seen = [i], {i}
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        reach[i] = min(seen)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: r for r in covertree.links(df).collect()}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (len(near[i]), reach[i], reach[i] == i) for i in near}
