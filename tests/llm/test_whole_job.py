"""Inputs that were cut, dropped or passed over before."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from loamstack.llm import html_text, license_scan, media, store, toxicity


def test_attributes_of_any_length_belong_to_their_tags():
    for quote in "\"'":
        long = quote + "A" * 200_000 + quote
        page = f"a<img src={long}>b<script data-x={long}>no()</script><div hidden title={long}>no</div><table><tr><td>c<td title={long}>d</table>"
        assert html_text.extract(page) == "ab\n\nc  d"


def test_spans_of_any_size_are_those_of_the_standard():
    assert [html_text._span(v, 1000, 1) for v in (None, "", "x", "0", "2", " 3px", "+4", "-1", "1000", "99999", "1" * 5000)] == [1, 1, 1, 1, 2, 3, 4, 1, 1000, 1000, 1000]
    page = "<table><tr><td rowspan=150>a<td>b" + "".join(f"<tr><td>{k}" for k in range(160)) + "</table>"
    lines = html_text.extract(page).split("\n")
    assert lines[0] == "a    b" and lines[149] == "     148" and lines[150] == "149"
    wide = html_text.extract("<table><tr><td colspan=900>head<td>end<tr><td>x</table>")
    assert wide.split("\n")[0].split() == ["head", "end"] and len(wide.split("\n")[0]) < 40


def brute_text(tree):
    """Visible words of a page that was made from ``tree``, in order."""
    out = []
    for node in tree:
        if isinstance(node, str):
            out += node.split()
        elif node[0] not in ("script", "style", "template") and "hidden" not in node[1]:
            out += brute_text(node[2])
    return out


def test_generated_pages_show_the_words_of_their_trees():
    """Random trees of blocks, inline elements, lists, hidden parts and scripts, with and without end tags that may be left out."""
    rng, blocks, inline = np.random.default_rng(5), ["div", "section", "blockquote", "ul", "h2"], ["b", "span", "em"]
    word = iter(f"w{k}" for k in range(10**6))

    def tree(depth, kinds):
        nodes = []
        for _ in range(rng.integers(1, 4)):
            pick = rng.random()
            if depth == 0 or pick < 0.35:
                nodes.append(" ".join(next(word) for _ in range(rng.integers(1, 4))) + " ")
            elif pick < 0.45:
                nodes.append((str(rng.choice(["script", "style", "template"])), "", ["hidden1 "]))
            else:
                name = str(rng.choice(kinds))
                if name == "ul":
                    nodes.append((name, "", [("li", "", tree(depth - 1, inline)) for _ in range(rng.integers(1, 3))]))
                else:
                    nodes.append((name, " hidden" if rng.random() < 0.1 else "", tree(depth - 1, inline if name in inline or name == "h2" else kinds)))
        return nodes

    def write(nodes):
        return "".join(n if isinstance(n, str) else f"<{n[0]}{n[1]}>{write(n[2])}" + ("" if n[0] == "li" else f"</{n[0]}>") for n in nodes)

    for _ in range(300):
        made = tree(4, blocks + inline)
        page = write(made)
        assert [w for w in html_text.extract(page).split() if w != "-"] == brute_text(made), page


def test_formulas_labels_and_inputs_are_shown():
    page = """<p>Let <math><mi>x</mi> <mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><semantics><mtext>for <b>all</b></mtext><annotation>no</annotation></semantics></math> hold.
<p>a<svg viewBox="0 0 1 1"><title>no</title><desc>no</desc><defs><text>no</text></defs><style/><rect style="display:none"/> no <g><text>North <tspan>pole</tspan></text><path d=""/><text>South</text></g></svg>b<svg>
<path d=""/></svg>c<p><svg><g>no<p>after <input type=tel value="+1 2"><input type="url" value=u><input type=number value=3><input type=date value=2020-01-01><input type=hidden value=no><input type=password value=no><input type=checkbox value=no>"""
    assert html_text.extract(page) == "Let x= 1 2 for all hold.\n\na North pole South bc\n\nafter +1 2 u 3 2020-01-01"


def test_elements_after_closed_and_open_diagrams():
    assert html_text.extract("<svg/>a<math/>b<svg><text>c<foreignObject><p>d<div>e</div></foreignObject></svg>f<ul><li>g</ul>") == "ab c\n\nd\n\ne\nf\n\n- g"


def test_near_dedup_judges_each_row(spark):
    text = lambda name: " ".join(f"{name}{k}" for k in range(40))
    rows = [(5, text("a")), (5, text("c") + " end"), (3, text("c")), (7, text("d")), (7, text("d")), (None, text("e")), (None, text("e") + " end"), (None, text("c")), (None, None), (9, ""), (2, text("f")), (8, text("f"))]
    docs = store.materialize(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(3), "odd")
    got = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    lone = [r for r in kept if r[1] in (text("e"), text("e") + " end")]
    assert len(lone) == 1 and lone[0][0] is None
    assert sorted([r for r in kept if r not in lone], key=str) == sorted([(5, text("a")), (3, text("c")), (7, text("d")), (None, None), (9, ""), (2, text("f"))], key=str)


def test_words_of_any_script_and_length_enter_whole():
    assert toxicity.words("It's a\u00a0b\u2014c\u201cd\u201d\u3000\u6f22\u5b57\u3002\u4eee\u540d\uff0ce\u200bf\u2026 \U0001f595 \u0e01\u0e34\u0e19") == [w.encode() for w in ("it's", "a", "b", "c", "d", "\u6f22\u5b57", "\u4eee\u540d", "e", "f", "\U0001f595", "\u0e01\u0e34\u0e19")]
    for n in (1, 40, 41, 72, 73, 1000):
        for start in (0x4E00, 97):
            word = "".join(chr(start + k % (26 if start == 97 else 5000)) for k in range(n))
            found = [p.decode() for p in toxicity.words(word)]
            assert max(map(len, found)) <= toxicity.PIECE and (n > 40 or found == [word])
            assert all(any(word[k : k + 5] in p for p in found) for k in range(n))


def test_toxic_words_late_in_an_unbroken_text_are_found():
    bad, plain = "\u6bd2\u8bcd\u6c61", [chr(0x5000 + k) for k in range(300)]
    # Drawn at random: letters that follow from k would tell odd k, the toxic texts, from even ones.
    filler = lambda k: "".join(np.random.default_rng(k).choice(plain, 150))
    texts = [filler(k) + (bad if k % 2 else "") + filler(k + 7)[:60] for k in range(400)]
    model = toxicity.train(texts, [k % 2 for k in range(400)])
    scores = toxicity.Scorer(model)([filler(901) + bad + filler(902), filler(901) + filler(902)])
    assert scores[0] > toxicity.THRESHOLD > scores[1]


def test_whole_texts_blocks_and_long_lines_state_their_licence(spark):
    full, notices = dict(license_scan.full_texts()), dict(license_scan.NOTICES)
    prose = " ".join(f"plain{k % 211} words{k % 89} of{k % 7}" for k in range(160))
    rows = [(name, f"{name}/LICENSE", "Copyright (c) 2020 Some One\n\n" + text) for name, text in full.items()]
    rows += [(f"below {name}", f"{name}/src/x", "some code") for name in full]
    rows += [("unwrapped", "p/q", " ".join(full["MIT"].split())), ("line", "p/r", f"{prose} Licensed under the Apache License, Version 2.0. {prose}")]
    words = notices["Apache-2.0"].split()
    rows += [("block", "p/s", "\n".join(f"# {' '.join(words[k : k + 4])}" for k in range(0, len(words), 4)) + "\n" + prose), ("prose", "p/t", prose)]
    rows += [("both", "t/COPYING", full["MIT"] + "\n" + full["BSD-3-Clause"])]
    keys = [r[0] for r in rows]
    files = spark.createDataFrame([(keys.index(k), path, text) for k, path, text in rows], "key long, path string, text string")
    got = {keys[r["key"]]: r for r in license_scan.scan(files).collect()}
    for name in full:
        assert (got[name]["license"], got[name]["is_file"]) == (name, True), got[name]
        assert (got[f"below {name}"]["license"], got[f"below {name}"]["inherited_from"]) == (name, name)
    assert (got["unwrapped"]["own_license"], got["unwrapped"]["is_file"]) == ("MIT", True)
    assert [(got[k]["own_license"], got[k]["is_file"]) for k in ("line", "block")] == [("Apache-2.0", False)] * 2
    assert got["both"]["is_file"] and got["both"]["own_license"] in ("MIT", "BSD-3-Clause")
    assert got["prose"]["own_license"] is None


def test_notices_are_met_exactly_among_heavy_words(spark):
    """As in a large table, where words that no template has weigh most."""
    templates = license_scan.TEMPLATES
    idf = {t: 4.0 for _, text in templates for t in license_scan._terms(text)}
    rows = [(k, "q " * (k % 5 + 101) + text + " z" * 100) for k, (_, text) in enumerate(templates)]
    found = license_scan.licence_windows(spark.createDataFrame(rows, "key long, text string"), "key", idf, 18.0, templates).collect()
    best = {k: max((r["cosine"], r["license"]) for r in found if r["key"] == k) for k in range(len(templates))}
    assert all(best[k] == (1.0, name) for k, (name, _) in enumerate(templates))


def test_every_window_is_scored():
    """A window at every word, against plain loops over blocks, words and windows."""
    rng = np.random.default_rng(3)
    model = toxicity.Model({f"w{k}".encode(): float(k % 5 - 2) for k in range(20)})
    model.p["words"] = rng.normal(0, 2, model.p["words"].shape)
    model.p["words"][0] = 0
    texts = [" ".join(rng.choice([f"w{k}" for k in range(60)], n)) for n in (0, 1, 5, 39, 40, 41, 69, 80, 81, 300, 20_000)]
    got = toxicity.Scorer(model)(texts)
    p, lead, block = model.p, toxicity.LEAD, toxicity.BLOCK
    for text, value in zip(texts, got):
        vectors = model.vectors([w.encode() for w in text.split()])
        n, e, o = len(vectors), [], []
        for at in range(0, n, block):
            x, mask = np.zeros((1, toxicity.SLICE, vectors.shape[1])), np.zeros((1, toxicity.SLICE))
            for k in range(toxicity.SLICE):
                if 0 <= at - lead + k < n:
                    x[0, k], mask[0, k] = vectors[at - lead + k], 1
            states = model.forward(x, mask, mask, keep=True)[1][0][0, lead : lead + min(block, n - at)]
            e += np.exp(np.tanh(states @ p["wa"] + p["ba"]) @ p["va"]).tolist()
            o += (states @ p["out"]).tolist()
        told = [np.dot(e[k : k + 40], o[k : k + 40]) / sum(e[k : k + 40]) for k in range(max(n - 39, 1))] if n else [0.0]
        assert abs(1 / (1 + np.exp(-max(told) - p["bias"][0])) - value) < 1e-4


def test_folded_pcm_is_whole():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 3, 64, 1001):
        for pcm in (rng.integers(-32768, 32768, n).astype(np.int16), np.zeros(n, np.int16), np.full(n, -32768, np.int16)):
            stored = media.fold(pcm)
            assert len(stored) == 2 * n and np.array_equal(media.unfold(stored), pcm)
    twice = media.resample_double(rng.integers(-9000, 9000, 500).astype(np.int16))
    assert not any(media.fold(twice)[1000:])


def test_resampled_pcm_is_stored_and_read_back(spark, monkeypatch):
    tables = {}
    keep = store.materialize
    monkeypatch.setattr(store, "materialize", lambda df, name, **options: tables.setdefault(name, keep(df, name, **options)))
    got = media.op7_media_columns(spark, "/root/testdata/sf0.001")
    stored = tables["media"].collect()
    assert stored and all(np.array_equal(media.unfold(r["pcm"]), media.resample_double(media.expand(r["media"]))) for r in stored)
    assert sorted(got.collect(), key=str) == sorted(media.media_features(tables["media"].drop("pcm")).collect(), key=str)
    assert sorted(((r["doc_id"], r["pcm"]) for r in media.pcm_column(tables["media"]).collect()), key=str) == sorted(((r["doc_id"], media.unfold(r["pcm"]).tobytes()) for r in stored), key=str)


def test_media_rows_equal_plain_loops(spark):
    """The query's columns against a loop over bytes with the formulas of the recommendation written out."""
    def mu(code):
        code = ~code & 255
        size = ((code & 15) * 8 + 132 << (code >> 4 & 7)) - 132
        return -size if code & 128 else size

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = media.op7_media_columns(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows[:60]:
        raw = (docs[r["doc_id"]] or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        wav = media.to_wav(payload)
        assert wav.endswith(payload) and int.from_bytes(wav[4:8], "little") == len(wav) - 8
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(wav), hashlib.sha256(wav).hexdigest())
        linear = [mu(b) for b in payload]
        wide = [v for a, b in zip(linear, linear[1:] + linear[-1:]) for v in (a, a + b >> 1)]
        pcm = b"".join(v.to_bytes(2, "little", signed=True) for v in wide)
        assert f"pcm16k={len(wide)}/{zlib.crc32(pcm)}" in r["feature"] and f"mulaw={max(linear)}/{min(linear)}/" in r["feature"]


def brute_scan(files):
    """license_scan.scan by plain loops: every line and every window of the stated starts, without passing any over."""
    L = license_scan
    words = lambda t: [w for w in re.split("[^a-z0-9]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    templates = L.TEMPLATES + L.NOTICES + L.full_texts()
    vocabulary = {t for _, text in templates for t in words(text)}
    total, df = len(files), Counter()
    for _, _, text in files:
        df.update(vocabulary & set(words(text)))
    idf = {t: math.log((1 + total) / (1 + df[t])) + 1 for t in vocabulary}
    unknown = math.log(1 + total) + 1

    def vector(found):
        v = {t: n * idf.get(t, unknown) for t, n in Counter(found).items()}
        return v, math.sqrt(sum(x * x for x in v.values()))

    made = [(name, words(text), *vector(words(text))) for name, text in templates]
    judged = {}
    for key, path, text in files:
        found, ranks, line_words, covered = words(text), [], 0, set()
        for k, line in enumerate((text or "").split("\n")):
            v, norm = vector(words(line))
            best = max(((round(sum(x * t.get(w, 0) for w, x in v.items()) / tn, 9), -i, name) for i, (name, _, t, tn) in enumerate(made[: len(L.TEMPLATES)]) if norm and set(v) & set(t)), default=None)
            if best and round(best[0] / norm, 6) >= L.THRESHOLD:
                ranks.append((1, -round(best[0] / norm, 6), 0, k, best[2]))
                line_words += len(words(line))
        for name, own, t, tn in made:
            n, last = len(own), max(len(found) - len(own), 0)
            least = max(L.THRESHOLD, L.LONG_THRESHOLD) if n > L.LONG else L.THRESHOLD
            for s in sorted({*range(0, last + 1, max(n // L.STEPS, 1)), last, *(s for s in range(last + 1) if s < len(found) and found[s] == own[0])}):
                v, norm = vector(found[s : s + n])
                cosine = round(sum(x * t.get(w, 0) for w, x in v.items()) / tn / norm, 6) if norm else 0
                if cosine >= least:
                    size = len(found[s : s + n])
                    ranks.append((0 if size >= L.FILE_SHARE * len(found) else 1, -cosine, 1, s, name))
                    covered |= set(range(s, s + size))
        best = min(ranks, default=None)
        judged[key] = (path, best and best[4], -best[1] if best else 0.0, bool(best) and max(line_words, len(covered)) >= L.FILE_SHARE * max(len(found), 1))
    given = {}
    for path, name, cosine, is_file in judged.values():
        if is_file and path is not None:
            given.setdefault(path.rpartition("/")[0], []).append((-cosine, name))
    out = {}
    for key, (path, name, cosine, is_file) in judged.items():
        parts = (path or "").split("/")[:-1]
        near = next((d for k in range(len(parts), 0, -1) if (d := "/".join(parts[:k])) in given), None) if path is not None else None
        out[key] = (name, cosine, is_file, name or (min(given[near])[1] if near is not None else None), near if name is None else None)
    return out


def test_scan_equals_plain_loops(spark):
    full, notices = dict(license_scan.full_texts()), dict(license_scan.NOTICES)
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect() if len(r["text"]) < 3000][:70]
    texts = docs + [t for _, t in license_scan.TEMPLATES] + list(notices.values()) + [full["MIT"], full["ISC"], full["BSD-3-Clause"], "(c) me\n\n" + full["MIT"], None, "", docs[0] + " " + notices["MIT"] + " " + docs[1], notices["GPL-3.0"] + "\nint main() { return 0; }"]
    folders = ["a/b", "a/b/c", "a", "d/e/f", "g"]
    files = [(k, None if k % 17 == 5 else f"{folders[k % 5]}/f{k}", t) for k, t in enumerate(texts)]
    want = brute_scan(files)
    rows = license_scan.scan(spark.createDataFrame(files, "key long, path string, text string")).collect()
    got = {r["key"]: (r["own_license"], r["cosine"], r["is_file"], r["license"], r["inherited_from"]) for r in rows}
    assert {k: (v[0], *v[2:]) for k, v in got.items()} == {k: (v[0], *v[2:]) for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in got)
    assert sum(v[0] is not None for v in got.values()) > 30 and any(v[4] for v in got.values())
