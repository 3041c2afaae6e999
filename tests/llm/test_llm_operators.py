"""The numbered operators against brute force on small fixtures: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from strata.llm import conversation_trie, decontamination, hard_negatives, html_text, license_scan, line_dedup, packing, pii, quality_rules, secret_scan, simhash, spilling_queue, token_counts, tokens, warc
from strata.llm.common import Scratch, placed, stage
from strata.llm.components import components

LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, source string"


def words(n: int, seed: int = 0, vocabulary: int = 5000) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) + str(r.randrange(vocabulary)) for _ in range(n)]


# ---------------------------------------------------------------- 1

def brute_contamination(text, items):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        size = min(13, len(w))
        for i in range(len(w) - size + 1) if w else ():
            for j in range(len(own) - size + 1):
                if own[j:j + size] == w[i:i + size]:
                    hit |= set(range(j, j + size))
                    found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found)


def test_decontamination(spark):
    item = words(40, 1)
    items = [(1, " ".join(item)), (2, "Únique  Word"), (3, None), (4, "!!"), (None, "z " * 14), (5, " ".join(item[5:25])), (10, "q")]
    docs = [(0, None), (1, ""), (2, " ".join(words(50, 2) + item[3:30] + words(700, 3))), (3, "a ÚNIQUE-word únique word b"), (4, "z " * 30), (4, "z " * 30),
            (5, "x" * 5000 + " " + ", ".join(item).upper()), (6, " ".join(item[:12])), (7, "--- q ---"), (8, "\n".join(words(3000, 4) + item))]
    d = spark.createDataFrame([(i, t, "m") for i, t in docs], "doc_id long, text string, match_items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (32 << 20, 20_000):
        out = decontamination.find_contamination(d, b, block_bytes=block)
        n, spans, found = out.columns[3:]
        assert found == "_match_items"
        rows = out.select("doc_id", n, decontamination.hit_words(F.col(spans)), found).collect()
        assert sorted((r[0], r[1], r[2], tuple(sorted(r[3]))) for r in rows) == sorted((i, *x[:2], tuple(x[2])) for i, t in docs for x in [brute_contamination(t, items)])
    kept = decontamination.decontaminate(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, t in docs for n, hit, _ in [brute_contamination(t, items)] if not (hit and 20 * hit >= n)}
    assert decontamination.find_contamination(d.limit(0), b).count() == 0 and decontamination.decontaminate(d, b.limit(0)).count() == len(docs)


# ---------------------------------------------------------------- 2

def test_pseudonyms(spark):
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "340000000000009", "4111111111111112"]
    text = "mail bob.smith42@mail.example.com, +1 (212) 555-0123 or 212-555-0123; 123-45-6789; 10.0.255.1; 2001-02-29 2000-02-29 31/12/1999 12/31/1999 31.04.2001; " + ", ".join(cards)
    rows = [(1, None, "a"), (2, "", "a"), (3, text, "a"), (4, "x " + text + " 999.1.1.1 1234567 1.2.3", "b"), (4, "no@ 000-12-1234", None)]
    out = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, replaced string"), "key")
    assert out.columns == ["doc_id", "text", "replaced", "_replaced"]
    got = {r.doc_id: r for r in out.collect() if r.text != "no@ 000-12-1234"}
    assert got[1].text is None and got[1]["_replaced"] == [] and got[2].text == ""
    new = got[3].text
    assert got[4].text == "x " + new + " 999.1.1.1 1234567 1.2.3"  # linked across documents
    for same in ("2001-02-29", "31.04.2001", "4111111111111112"):
        assert same in new
    for gone in ("bob.smith42", "555-0123", "123-45-6789", "10.0.255.1", "2000-02-29", "31/12/1999", "12/31/1999", *cards[:3]):
        assert gone not in new, gone
    shape = lambda s: re.sub("[0-9]+", "9", re.sub("[A-Za-z]", "x", s))
    assert shape(new) == shape(text)
    for card in re.findall(r"\b\d{4} \d{4} \d{4} \d{4}\b|\b\d{4}-\d{4}-\d{4}-\d{4}\b", new):
        d = [int(c) for c in card if c.isdigit()]
        assert sum(sum(divmod(2 * x, 10)) if i % 2 == len(d) % 2 else x for i, x in enumerate(d)) % 10 == 0
    other = pii.pseudonymise(spark.createDataFrame(rows[2:3], "doc_id long, text string, replaced string"), "other").first().text
    assert other != new


def test_pseudonyms_are_a_permutation(spark):
    n = spark.range(0, 73049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text")).limit(4000)
    out = pii.pseudonymise(n, "k")
    assert out.select("text").distinct().count() == 4000 and out.where("text < '1900-01-01' or text > '2099-12-31'").count() == 0


def test_phones_of_any_digits_and_cards_beside_digits(spark):
    phones = ["+1 (017) 555-7713", "(212) 155-0123", "000.123.4567"]
    card = "4111 1111 1111 1111"
    around = ["{}", "{} 12/27", "{} 123", "12 34 {}", "no 5 {} 1 2", "{} 123-45-6789", "{} 2001-03-04", "{} 212-555-0123", "{} 378282246310005", "378282246310005 {}", "{0} {0}"]
    texts = phones + [a.replace("{0}", "{}").format(*[c] * a.count("{")) for c in (card, card.replace(" ", ""), "5500-0000-0000-0004", "3782 822463 10005") for a in around]
    texts += ["4000 0000 0000 0000 006", "411 111 111 111 1111", "4111 1111 1111 1112 12", "1 " * 20_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(rows, "key").collect()}
    new = [got[i].text for i in range(len(texts))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    for i, phone in enumerate(phones):
        assert re.sub("[0-9]", "9", new[i]) == re.sub("[0-9]", "9", phone) and digits(new[i])[-10:] != digits(phone)[-10:] and got[i].replaced[0].kind == "phone"
    for k in range(4):
        at = 3 + k * len(around)
        old, own = texts[at], new[at]
        assert digits(own) != digits(old)
        for j, a in enumerate(around[:5]):
            assert new[at + j] == a.format(own), texts[at + j]
        for j in (5, 6, 7):
            assert new[at + j].startswith(own + " ") and texts[at + j][len(old):] not in new[at + j] and len(got[at + j].replaced) == 2
        for j, a in ((8, new[at + 8]), (9, new[at + 9])):
            assert own in a and "378282246310005" not in a and len(got[at + j].replaced) == 2
        assert new[at + 10] == f"{own} {own}"
    n = len(texts)
    assert new[n - 4] != texts[n - 4] and new[n - 3] != texts[n - 3] and new[n - 2] == texts[n - 2] and len(new[n - 1]) == 40_000
    ten = spark.range(0, 4000).select(F.concat_ws("-", F.lit("017"), F.lpad(F.floor(F.col("id") / 10).cast("string"), 3, "0"), F.lpad((F.col("id") % 10).cast("string"), 4, "0")).alias("text"))
    assert pii.pseudonymise(ten, "k").select("text").distinct().count() == 4000


def brute_permuted(value, left, right, key, kind):
    """The Feistel network in plain Python."""
    a, b = divmod(value, right)
    digest = lambda *parts: hashlib.sha256("|".join(parts).encode()).hexdigest()
    for i in range(1, pii.ROUNDS + 1):
        other, size = (b, left) if i % 2 == 0 else (a, right)
        by = int(digest(key, digest(key, kind, str(i), str(size), str(other)))[:15], 16) % size
        a, b = ((a + by) % left, b) if i % 2 == 0 else (a, (b + by) % right)
    return a * right + b


def test_pseudonyms_match_a_plain_feistel_network(spark):
    import datetime

    def date(y, m, d):
        v = (datetime.date(y, m, d) - datetime.date(1900, 1, 1)).days
        while True:
            v = brute_permuted(v, 271, 270, "k", "date")
            if v < 73049:
                return datetime.date(1900, 1, 1) + datetime.timedelta(v)

    home = lambda d: f"{brute_permuted(int(d), 10**6, 10**4, 'k', 'phone'):010d}"
    abroad = lambda d: d[:2] + f"{brute_permuted(int(d[2:]), 10**(len(d[2:]) - len(d[2:]) // 2), 10**(len(d[2:]) // 2), 'k', 'phone'):0{len(d) - 2}d}"
    a, b, c = date(2024, 1, 5), date(2024, 1, 6), date(1980, 5, 4)
    f = home("2125550123")
    g = abroad("442079460958")
    cases = {
        "2024-01-05-2024-01-06": f"{a}-{b}", "4/5/1980": f"{c.day}/{c.month}/{c.year}", "1980-5-4": f"{c.year}-{c.month}-{c.day}", "04.05.1980": f"{c:%d.%m.%Y}",
        "31.2.1980 and 1.2.3": "31.2.1980 and 1.2.3", "call 2125550123 now": f"call {f} now", "212-555-0123": f"{f[:3]}-{f[3:6]}-{f[6:]}", "12125550123": "1" + f,
        "1234567890 x2125550123 2125550123a": "1234567890 x2125550123 2125550123a", "+44 20 7946 0958": f"+{g[:2]} {g[2:4]} {g[4:8]} {g[8:]}", "+442079460958": "+" + g,
        "10.0.0.1": ".".join(str(brute_permuted(10 << 24 | 1, 1 << 16, 1 << 16, "k", "ip") >> k & 255) for k in (24, 16, 8, 0)),
    }
    df = spark.createDataFrame(list(cases.items()), "text string, want string")
    for row in pii.pseudonymise(df, "k").collect():
        assert row.text == row.want


def test_pseudonyms_of_accounts_and_cased_addresses(spark):
    check = lambda s: int("".join(str(int(x, 36)) for x in s[4:] + s[:4])) % 97
    rows = ["GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "pay DE89 3704 0044 0532 0130 00 NOW", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 33", "FR76 3000 6000 0112 3456 7890 189 TEXT",
            "Bob@x.com", "bob@x.com", "BOB@x.com"]
    new = [r.text for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), "k").orderBy("doc_id").collect()]
    assert new[0].replace(" ", "") == new[1] != rows[1] and check(new[1]) == 1 and new[1][:2] == "GB" and re.sub("[A-Z]", "A", re.sub("[0-9]", "9", new[0])) == re.sub("[A-Z]", "A", re.sub("[0-9]", "9", rows[0]))
    assert new[2] == f"pay {' '.join(re.findall('.{1,4}', new[3]))} NOW" and check(new[3]) == 1 and new[3] != rows[3]
    assert new[4] == rows[4] and new[5].endswith(" TEXT") and check(new[5][:-5].replace(" ", "")) == 1 and new[5] != rows[5]
    assert new[6].lower() == new[7] == new[8].split("@")[0].lower() + "@x.com" != rows[7] and new[6][0].isupper() and new[6][1:] == new[7][1:]


def test_pseudonym_key_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    session = lambda master, key: SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: key or default), sparkContext=SimpleNamespace(master=master))
    assert pii.session_key(spark) == pii.DEFAULT_KEY and pii.session_key(session("yarn", "own")) == "own"
    with pytest.raises(ValueError, match="strata.pii.key"):
        pii.session_key(session("yarn", None))


def test_pseudonyms_of_an_empty_table_and_repeated_rows(spark):
    rows = [(1, "mail a.b@c.org")] * 3 + [(None, "10.0.0.1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r)[:2] for r in pii.pseudonymise(df, "k").collect()]
    assert len(out) == 4 and len(set(out)) == 2 and not any("a.b@" in t or "10.0.0.1" in t for _, t in out)
    assert pii.pseudonymise(df.limit(0), "k").count() == 0


def test_pseudonym_of_an_address_of_many_labels(spark):
    """A domain of any length is matched without a call for each label, which ended the JVM."""
    domain = ".".join(["ab"] * 20_000)
    new = pii.pseudonymise(spark.createDataFrame([(1, f"x@{domain} and bob@{domain}")], "doc_id long, text string"), "k").first()
    assert [r.kind for r in new.replaced] and {r.kind for r in new.replaced} == {"email"}
    assert new.text.count(f"@{domain}") == 2 and not new.text.endswith(f"bob@{domain}")


# ---------------------------------------------------------------- 3

def brute_quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams, marked = {}, set()
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    for at in grams.values():
        if len(at) > 1:
            marked |= {i + k for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(marked)


def test_quality_rules(spark):
    template = "\n".join(" ".join(words(30, s)) for s in range(3))
    rows = [(i, f"{template}\n{' '.join(words(9, 100 + i))}", "site") for i in range(30)]
    rows += [(100 + i, " ".join(words(60, 500 + i)), "site") for i in range(15)] + [(200, rows[0][1], "other"), (201, None, None), (202, "", "site"), (202, "", "site")]
    rows += [(203, "a b c a b c " * 40, "x"), (204, "# é 　 <>\n\n\t\n# é 　 <>", "x"), (205, " ".join(words(20000, 7)), None)]
    out = quality_rules.quality_rules(spark.createDataFrame(rows, DOCS + "").withColumn("kept", F.lit("mine")))
    assert out.columns[3:] == ["kept", *quality_rules.STATISTICS, "base_failed", "_kept"]
    for r in out.collect():
        text = next(t for i, t, _ in rows if i == r.doc_id)
        want = brute_quality(text)
        assert tuple(r)[4:9] == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["_kept"] == (not r.base_failed and not r.doc_id < 30), r.doc_id
    copies = spark.createDataFrame([(i, rows[0][1], "site") for i in range(100)], DOCS)
    assert quality_rules.keep_good(copies).count() == 100 and quality_rules.keep_good(copies.limit(0)).count() == 0


def test_lines_above_the_limit_are_removed(spark):
    own = lambda i: " ".join(words(60, 900 + i))
    rows = [(i, f"Shared  LINE é\n\n{own(i)}\nshared line é\n{own(i)}\n", "a") for i in range(25)]
    rows += [(100 + i, own(100 + i), "a") for i in range(5)] + [(200, rows[0][1], "b"), (201, None, "a")]
    docs = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    for i, text, host in rows:
        assert out[i].text == (f"\n{own(i)}\n{own(i)}\n" if i < 25 else text), i
        assert tuple(out[i])[3:8] == brute_quality(text)
    single = docs.withColumn("text", F.regexp_replace("text", r"(?s)shared line é\n.*", ""))
    kept = {r.doc_id: r.text for r in quality_rules.keep_good(single).collect()}
    assert kept[0] == f"\n{own(0)}\n" and kept[200] == f"Shared  LINE é\n\n{own(0)}\n" and 201 not in kept


# ---------------------------------------------------------------- 4

def least_sequences(pieces, capacity):
    """The fewest sequences, by trying all places of each piece."""
    best = [len(pieces)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= pieces[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - pieces[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - pieces[i]])

    place(0, [])
    return best[0]


def test_best_fit_by_groups_is_that_of_single_pieces():
    r = np.random.default_rng(1)
    for _ in range(200):
        histogram = {int(n): int(c) for n, c in zip(r.choice(np.arange(1, 41), 8, False), r.integers(1, 30, 8))}
        rooms = []
        for n in sorted(histogram, reverse=True):
            for _ in range(histogram[n]):
                fits = [k for k, x in enumerate(rooms) if x >= n]
                k = min(fits, key=lambda k: rooms[k]) if fits else rooms.append(40) or len(rooms) - 1
                rooms[k] -= n
        found = packing.best_fit(histogram, 40)
        assert sorted(40 - sum(n * a for n, a in c.items()) for c, x in found for _ in range(x)) == sorted(rooms)


def test_configurations_hold_every_piece():
    r = np.random.default_rng(0)
    many = np.clip(r.lognormal(5.8, 1, 20000), 1, 1024)
    for lengths, times in ((many, 1), (many, 30), (many, 10 ** 6), (r.integers(500, 700, 3000), 1), (np.array([1024] * 5 + [600] * 7 + [1] * 3), 1), (np.array([3]), 10 ** 9)):
        histogram = {int(n): int(c) * times for n, c in zip(*np.unique(lengths.astype(int), return_counts=True))}
        found, bound = packing.configurations(histogram)
        held = {}
        for config, x in found:
            assert x > 0 and sum(n * a for n, a in config.items()) <= 1024
            for n, a in config.items():
                held[n] = held.get(n, 0) + a * x
        assert held == histogram
        n, plain = sum(x for _, x in found), sum(x for _, x in packing.best_fit(histogram, 1024))
        assert bound <= n <= max(plain, int(1.0005 * bound) + 1)
    assert packing.configurations({}) == ([], 0)


def test_sequences_are_as_few_as_the_least():
    r = np.random.default_rng(2)
    for _ in range(40):
        pieces = sorted(r.integers(1, 13, r.integers(1, 10)).tolist(), reverse=True)
        found, bound = packing.configurations({n: pieces.count(n) for n in pieces}, 12)
        least = least_sequences(pieces, 12)
        assert bound <= least <= sum(x for _, x in found) <= least + 1


def test_the_fractional_solution_is_of_full_sequences_in_proportion():
    r = np.random.default_rng(3)
    demand = {int(n): int(c) for n, c in zip(*np.unique(np.clip(r.lognormal(5, 1, 50000), 1, 1023).astype(int), return_counts=True))}
    found, bound = packing.solve(demand)
    covered = {}
    for config, x in found.items():
        assert x > 0 and sum(n * a for n, a in config) == 1024
        for n, a in config:
            covered[n] = covered.get(n, 0) + a * x
    assert all(c <= (1 + packing.SLACK) * demand[n] + 1e-6 for n, c in covered.items())
    assert sum(found.values()) > 0.5 * bound and bound <= sum(n * c for n, c in demand.items()) / 1024 + 1e-6


def test_packing(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokens.default_path())
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (3, "a <|endoftext|> b"), (4, " ".join(words(5000, 1))), (None, "x y z")] + [(10 + i, " ".join(words(i, i))) for i in range(60)]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, part string").repartition(3)
    out = packing.pack(df, with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            want.append((str(i), k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()), tuple(ids[s:s + n])))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in out) == sorted(want)
    lengths = [r.length for r in out]
    assert len({r.sequence_id for r in out}) <= sum(x for _, x in packing.best_fit({n: lengths.count(n) for n in lengths}, 1024))
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for at in sequences.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 5

def test_warc_round_trip(spark, tmp_root):
    same, long = "x" * 200, "é" * 300_000
    pages = [(5, "http://a", same), (3, "http://b\r\nX: y", same), (3, "http://c", same), (None, None, same), (7, "u", None), (8, "u", ""), (9, "u", "short"), (1, "u", "short"), (2, "ü", long), (4, "v", long)]
    df = stage(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2), "t")
    manifest = warc.write_warc(warc.records(df, "page_id", "url", "html"), tmp_root + "/warc", chunk_bytes=1000, file_bytes=2000)
    rows = warc.read_warc(manifest, 1000, with_payload=True).collect()
    texts = {}
    for r in sorted(rows, key=lambda r: (r.record_id, r.chunk)):
        texts[r.record_id] = texts.get(r.record_id, b"") + r.payload
        assert r.n_bytes <= 1000
        if r.record_type == "response":
            assert r.digest_so_far == hashlib.sha256(texts[r.record_id]).hexdigest() and r.bytes_so_far == len(texts[r.record_id])
    last = [r for r in rows if r.last]
    assert len(last) == len(pages) and manifest.agg(F.sum("n_records")).first()[0] == len(pages)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in last)
    kind = {0: "revisit", 3: "revisit", 9: "revisit", 2: "revisit"}
    want = sorted((str(p), len((t or "").encode()), hashlib.sha256((t or "").encode()).hexdigest(), kind.get(i, "response"), {0: "3", 2: "3", 3: "3", 9: "2"}.get(i)) for i, (p, _, t) in enumerate(pages))
    assert got == want
    assert warc.read_warc(warc.write_warc(warc.records(df.limit(0), "page_id", "url", "html"))).count() == 0


def test_warc_of_long_urls_and_broken_archives(spark, tmp_root):
    import gzip

    pages = [(1, "u" * 3_000_000, "p" * 700_000), (2, "v", "p" * 700_000), (3, None, None), (4, "w", "")]
    df = spark.createDataFrame([(*p, "mine") for p in pages], "page_id long, url string, html string, record string").repartition(1)
    manifest = warc.write_warc(warc.records(df, "page_id", "url", "html"))
    out = {r.page_id: r for r in warc.read_warc(manifest).where("last").collect()}
    assert {i: (r.url, r.payload_bytes, r.record_type) for i, r in out.items()} == {
        "1": ("u" * 3_000_000, 700_000, "response"), "2": ("v", 700_000, "revisit"), "3": (None, 0, "response"), "4": ("w", 0, "response")}
    path = manifest.first().path.removeprefix("file:")
    whole = gzip.decompress(open(path, "rb").read())
    cuts = {"inside record": whole[:whole.find(b"ppppp") + 9], "inside a header": whole[:200], "match its digest": whole.replace(b"pppp", b"pqpp", 1)}
    for message, body in cuts.items():
        name = f"{path}.{message.split()[0]}.warc"
        open(name, "wb").write(body)
        with pytest.raises(ValueError, match=message):
            list(warc.read_records(f"file:{name}"))


# ---------------------------------------------------------------- 6

def test_main_text():
    body = "<h1>Title &amp; more</h1><p>First  para\n of <b>text</b>.<p>Second&nbsp;one.<br>x</p><aside>side bar</aside><p>Short.</p><div class='ad'>buy</div><ul><li>item <a href=x>link</a></li></ul>"
    page = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p><p>';</script><body class=home><nav><a href=/>Home</a></nav><header>Site</header><div class='cookie-notice'>We use cookies and many words to say so, at length, in every page of this site.</div><article>{body}</article><section id=comments><p>{'A reader says a lot. ' * 40}</p></section><form><p>search</p></form><footer>&copy; x</footer></body></html>"
    want = "Title & more\nFirst para of text.\nSecond one. x\nShort.\nitem link"
    assert html_text.main_text(page) == want
    assert html_text.main_text(page.replace("<article>", "<div>").replace("</article>", "</div>")).split("\n")[:3] == want.split("\n")[:3]
    for empty in (None, "", "<p></p>", "<!-- <p>x</p>", "<script>x", "<"):
        assert html_text.main_text(empty) in ("", "<")
    assert html_text.main_text("plain <b text") == "plain" and html_text.main_text("<p a='x>1</p><p>2") in ("2", "1\n2")
    assert html_text.main_text("<div>" * 50_000 + "x") == "x" and len(html_text.main_text("<p>a" * 20_000)) == 39_999


def test_dropped_elements_split_no_text():
    words_ = lambda n, s: " ".join(words(n, s))
    long, short = words_(300, 1), words_(9, 2)
    body = "<h1>Title &amp; more</h1><p>First  para\n of <b>text</b>.<p>Second&nbsp;one.<br>x</p><aside>side bar</aside><p>Short.</p><div class='ad'>buy</div><ul><li>item <a href=x>link</a></li></ul>"
    want = "Title & more\nFirst para of text.\nSecond one. x\nShort.\nitem link"
    assert html_text.main_text(f"<body><nav>Home</nav><div>{body}</div><section id=comments>{'<p>says a lot</p>' * 40}</section><footer>x</footer>") == want
    for cut in ("<aside>x</aside>", "<form>y<p>z</form>", "<div class=ad>x</div><nav>y</nav>"):
        for page in (f"<div><p>{long}</p>{cut}<p>{short}</p></div>", f"<body><p>{long}</p>{cut}<p>{short}", f"<div><div>{long}</div>{cut}<div><p>{short}</div></div>"):
            assert html_text.main_text(page) == f"{long}\n{short}", page
        assert html_text.main_text(f"<body><div>{long}</div>{cut}<div>{short}</div>") == long  # regions of the page stay apart
        assert html_text.main_text(f"<body><div><p>{long}</p>{cut}</div><div>{short}</div>") == long


def test_wrappers_of_the_article_are_read():
    text, ad = " ".join(words(60, 1)), "<div class=ad>buy</div><nav><a href=/>Home</a></nav>"
    for name in ("layout has-sidebar", "no-comments", "widget-area", "with-banner", "post share", "sidebar"):
        for tag in ("article", "main"):
            assert html_text.main_text(f"<body>{ad}<div class='{name}'><{tag}><p>{text}</p></{tag}>{ad}</div><footer>f</footer>") == text
        assert html_text.main_text(f"<body>{ad}<p>Skip</p><nav>x</nav><div class='{name}'><h1>T</h1><p>{text}</p>{ad}</div>") == f"T\n{text}"
    for page in (f"<form><main>{text}</main></form>", f"<form>{ad}<div class='post share'><article>{text}</article></div></form>", f"<body><div class=widget><p>{text}</p></div>"):
        assert html_text.main_text(page) == text
    more = "".join(f"<article class=comment>{' '.join(words(50, 9 + i))}</article>" for i in range(9))
    assert html_text.main_text(f"<div class='post share'><article>{text}{text}</article><section id=comments>{more}</section></div>") == text + text
    assert html_text.main_text(f"<article>{text}</article><section class=related>{more}</section>") == text
    assert html_text.main_text("<div class=ad>" * 20_000 + "x") == "x"


def test_article_text_is_whole():
    text, short = " ".join(words(200, 1)), " ".join(words(30, 2))
    links = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(6))
    listed = "\n".join(f"link {i}" for i in range(6))
    assert html_text.main_text(f"<nav><ul>{links}</ul></nav><article><p>{text}</p></article><article><p>Second.</p></article>") == f"{text}\nSecond."
    assert html_text.main_text(f"<article><p>{text}</p></article><section><article class=comment><p>{text}</p></article></section>") == text
    assert html_text.main_text(f"<body><section><p>{text}</p></section><aside>x</aside><section><p>{short}</p></section>") == f"{text}\n{short}"
    for wrap in ("<div>{}</div>", "<article>{}</article>"):
        body = f"<h1>T</h1><p>{text}</p><ul>{links}</ul><p>End.</p><p class=alert>Mind this.</p><p class='market-share'>A third.</p><p>Press <button>OK</button> now</p><p><button>Share</button></p>"
        page = f"<body><ul>{links}</ul><p class='cookie-notice'>{short}</p>{wrap.format(body)}<p class=alert>site</p><footer>f</footer>"
        assert html_text.main_text(page) == f"T\n{text}\n{listed}\nEnd.\nMind this.\nA third.\nPress OK now", wrap
    assert html_text.main_text(f"<div><a href=/>Home</a><p>{text}</p></div>") == text  # links before the text are a menu
    assert html_text.main_text("<p>tie</p><nav>x</nav><div>tie</div>") == "tie"  # of equal regions under the height of a paragraph the first
    assert html_text.main_text(f"<p><span class=widget>{text}</span></p>") == text


@given(st.lists(st.integers(0, 3), max_size=30), st.integers(1, 4))
def test_regions_match_brute_force(lengths, window):
    sums = [sum(lengths[i:i + window]) for i in range(len(lengths))]
    want = []
    for i, n in enumerate(sums):
        if n and (i == 0 or not sums[i - 1]):
            dive = next((j for j in range(i, len(sums)) if not sums[j]), len(sums))
            want.append((i, dive, max(sums[i:dive])))
    assert html_text.regions(lengths, window) == want


def test_given_pages_match_a_parser():
    """Every page of the smallest scale against the standard library's parser, which takes the blocks inside <article>."""
    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.depth, self.blocks = 0, [""]

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            self.blocks += [""] if tag in ("p", "h1", "li", "ul", "div", "article") else []
            self.blocks[-1] += " " if tag == "br" else ""

        def handle_endtag(self, tag):
            self.depth -= tag == "article"
            self.blocks += [""] if tag in ("p", "h1", "li", "ul", "div", "article") else []

        def handle_data(self, data):
            self.blocks[-1] += data if self.depth else ""

    for page in pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["html"]).column(0).to_pylist():
        parser = Article()
        parser.feed(page)
        parser.close()
        assert html_text.main_text(page) == "\n".join(" ".join(b.split()) for b in parser.blocks if b.strip())


def test_extract_text(spark):
    df = spark.createDataFrame([(1, "u", "<p>é x", "mine"), (1, "u", "<p>é x", "mine"), (2, None, None, "m")], "page_id long, url string, html string, text string")
    out = html_text.extract_text(df)
    assert out.columns == ["page_id", "url", "text", "_text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "u", "mine", "é x", 3)] * 2 + [(2, None, "m", "", 0)], key=str)
    assert html_text.extract_text(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 7

def test_token_counts(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokens.default_path())
    odd = ["'s 'll don't  \n\n x　y 12٣ <|endoftext|><|endoftext|>  é́", "a" * 3000 + " b", " ".join(words(4000, 3)), None, "", "x", "x"]
    df = spark.createDataFrame([(i % 6, t, 5) for i, t in enumerate(odd)], "doc_id long, text string, n_tokens int").repartition(3)
    want = sorted((i % 6, 5, len((t or "").encode()), len(own.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(odd))
    for head in (100_000, 10, 0):
        out = token_counts.count_tokens(df, head_size=head)
        assert out.columns == ["doc_id", "n_tokens", "n_bytes", "_n_tokens"]
        assert sorted(map(tuple, out.collect())) == want
    assert token_counts.count_tokens(df.limit(0)).count() == 0
    for t in odd:
        assert tokens.encoder(None)(t or "").tolist() == own.encode(t or "", add_special_tokens=False).ids


# ---------------------------------------------------------------- 8

def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(secret_scan.ASSIGN, text, re.ASCII) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secret_scan(spark):
    key, spread, common = "aB3" * 9, "zX9" * 8, "Q7" * 11
    texts = ["", None, "é PassWord = \"abc123\" secret=token:abcdefgh token:'x' api-key: APIKEY=abcdef0 to\u212Aen=abcdefgh", f"é AKIA{'A' * 16} AKIAAKIA " + "0123456789abcdef" * 2 + " AKIAB",
             f"{key} and {spread}", f"{spread} token={spread}", " ".join("deadbeef" * 3 + str(i) for i in range(3000)), f"third {spread}"]
    rows = [(i, t, f"owner{i}") for i, t in enumerate(texts)] + [(4, texts[4], "owner4"), (50, "password=hunter22", None)]
    rows += [(60, texts[4], "other")]  # a copy in a second source is the same repository and owner
    rows += [(100 + i, f"{common} in text {i}", "one") for i in range(10)]  # one owner, but many texts
    values = [(i, t, s, {t[m.start():m.end()] for m in re.finditer(secret_scan.CANDIDATE, t or "") if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])}) for i, t, s in rows]
    holders = {}  # value -> text -> owners
    for i, t, s, found in values:
        named = [m[2] for m in re.finditer(secret_scan.ASSIGN, t or "", re.ASCII) if len(m[2]) >= 6] + re.findall("AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", t or "")
        for v in {*found, *named}:
            holders.setdefault(v, {}).setdefault(t, set()).add(s or "")
    live = {v for v, by in holders.items() if len({min(o) for o in by.values()}) <= 2 and len(by) <= 9}
    assert key in live and spread not in live and common not in live
    out = secret_scan.scan_secrets(spark.createDataFrame(rows, DOCS))
    for r in out.collect():
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        assert [(s.start, s.kind, s.end) for s in r.base] == brute_spans(text), r.doc_id
        extra = [text[s.start:s.end] for s in r.spans if s.kind == 3]
        assert extra == [m[0] for m in re.finditer(secret_scan.CANDIDATE, text) if m[0] in live and re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])], r.doc_id
        assert [(s.start, s.kind, s.end) for s in r.spans if s.kind < 3] == brute_spans(text)
        assert all(s.live == (s.value in live) for s in r.spans)
    assert out.count() == len(rows) and secret_scan.scan_secrets(out.select("doc_id", F.lit("").alias("text"), F.lit("").alias("source")).limit(0)).count() == 0


# ---------------------------------------------------------------- 9

def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, within):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    listed = sorted(values)
    for i, a in enumerate(listed):
        for b in listed[i + 1:]:
            if within(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_keys_meet_within_three_bits():
    r = np.random.default_rng(1)
    marks = r.integers(0, 1 << 63, 200).astype(np.uint64)
    for distance in (1, 2, 3):
        other = marks.copy()
        for i in range(len(other)):
            for b in r.choice(64, distance, replace=False):
                other[i] ^= np.uint64(1) << np.uint64(b)
        own = set(zip(*(x.tolist() for x in simhash.keys_of(marks))))
        assert {row for row, key in zip(*(x.tolist() for x in simhash.keys_of(other))) if (row, key) in own} == set(range(len(marks)))


@pytest.mark.parametrize("most", [1 << 16, 8])
def test_links_find_all_components(spark, most):
    r = random.Random(3)
    marks = {r.getrandbits(64) for _ in range(40)}
    for center in list(marks)[:3]:
        chain = center
        for _ in range(25):
            chain ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 4)))
            marks |= {chain, center ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))}
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    links = simhash.links_within(spark.createDataFrame([(m,) for m in signed], "mark long"), 3, most)
    got = {x.node: x.root for x in components(links).collect()}
    want = brute_components(signed, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 3)
    assert all(got.get(m, m) == want[m] for m in signed)


def test_near_duplicates(spark):
    texts = [None, "", "  \n", "one", "One two", "one  TWO", " ".join(words(300, 1)), " ".join(words(300, 1)[:-1] + ["changed"]), "x " * 5000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(6, texts[6], "s"), (None, texts[6], "s")]
    df = stage(spark.createDataFrame(rows, "doc_id long, text string, mark string"), "t")
    out = simhash.near_duplicates(df).collect()
    marks = {t: brute_fingerprint(t) for t in texts}
    root = brute_components(set(marks.values()), lambda a, b: bin(a ^ b).count("1") <= 3)
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[root[marks[t]]] = min(least.get(root[marks[t]], i), i)
    by_id = {i: t for i, t, _ in rows if i is not None}
    for r in out:
        text = texts[6] if r.doc_id is None else by_id[r.doc_id]
        assert r.fingerprint == f"{marks[text]:016x}" and r.component_id == least[root[marks[text]]]
    assert len(out) == len(rows)
    kept = simhash.keep_first(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted(least.values())
    assert simhash.keep_first(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 10

def brute_lines(rows):
    sets, out = [], []
    for _, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            own = frozenset(re.findall(r"[^\x20\x09-\x0D]+", line.translate(LOWER)))
            if own and any(5 * len(own & s) >= 4 * len(own | s) for s in sets):
                sets.append(own)
                continue
            if own:
                sets.append(own)
            kept.append(line)
        out.append(None if text is None else "\n".join(kept))
    return out


@pytest.mark.parametrize(("most", "first_few"), [(1 << 12, 64), (8, 2)])
def test_line_dedup(spark, most, first_few):
    r = random.Random(5)
    base = [words(r.randint(1, 40), s, 20) for s in range(30)]
    rows = [(0, None), (1, ""), (2, "\n\n \n"), (3, "A b c d\na  B c d\na b c d e\na b c x")]
    for i in range(4, 80):
        lines = []
        for _ in range(r.randint(1, 6)):
            line = list(r.choice(base))
            for _ in range(r.randint(0, 5)):
                line[r.randrange(len(line))] = f"w{r.randrange(50)}"
            r.shuffle(line)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    rows.append((90, " ".join(words(6000, 99)) + "\n" + " ".join(words(6000, 99)[::-1])))
    df = stage(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row int").repartition(3), "t")
    out = line_dedup.dedup_lines(df, most=most, first_few=first_few)
    assert out.columns == ["doc_id", "text", "row", "n_lines", "n_removed"]
    got = {x.doc_id: x for x in out.collect()}
    assert [got[i].text for i, _ in rows] == brute_lines(rows)
    twice = spark.createDataFrame([(1, "p q r s"), (1, "p q r s"), (None, "p q r s")], "doc_id long, text string")
    assert sorted((str(x.doc_id), x.n_removed) for x in line_dedup.dedup_lines(twice).collect()) == [("1", 0), ("1", 1), ("None", 1)]
    assert line_dedup.dedup_lines(twice.limit(0)).count() == 0


def test_line_dedup_table_grows_with_what_it_holds(spark, monkeypatch):
    """However many sets may match, few others are found in the table of possible matches."""
    monkeypatch.setattr(line_dedup, "POSSIBLE_BITS", 10)
    r = random.Random(9)
    vocabulary = [f"v{i}" for i in range(900)]
    lines = [r.sample(vocabulary, 14) for _ in range(400)]
    texts = [(2 * i + k, " ".join([*x, f"e{k}"])) for i, x in enumerate(lines) for k in range(2)]
    df = stage(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), "t")
    frequency = spark.sparkContext.broadcast(line_dedup.frequencies(df.select("text")))
    with Scratch(spark) as scratch:
        table = line_dedup.possible_matches(df.select("text"), frequency, scratch)
    n_set, n_bits = int(np.bitwise_count(table).sum()), table.size * 64
    assert n_set >= 2 * len(lines) and 8 * n_set < n_bits
    others = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert line_dedup._has(table, others).mean() < 0.02
    assert [x.n_removed for x in line_dedup.dedup_lines(df).orderBy("doc_id").collect()] == [0, 1] * len(lines)


def test_line_dedup_of_many_lines_of_one_template(spark):
    """A third of all lines and more are of one template: short ones that differ in a word match none, long ones match the first; no pairs are made."""
    import time

    n, size = 100_000, 50
    short, long = "published here by admin on", " ".join(words(20, 7))
    rows = [(i, "\n".join([*(f"{short} d{i * size + k}" for k in range(size // 2)), *(f"{long} e{i * size + k}" for k in range(size // 2))])) for i in range(n // size)]
    df = stage(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "t")
    began = time.monotonic()
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(df).collect()}
    assert got == {i: (size, size // 2 - (i == 0)) for i, _ in rows}
    assert time.monotonic() - began < 90


# ---------------------------------------------------------------- row identity

@pytest.fixture()
def splits(spark):
    """Sets the number of splits of later scans."""
    names = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(names, (str(n), "128m" if n < 4 else "8k", "4m" if n < 4 else "1"))]
    for name in names:
        spark.conf.unset(name)


def test_rows_keep_their_numbers_when_the_splits_change(spark, splits, tmp_root):
    """The plan is built with few splits and run with many, as after a change of executors."""
    shared = [" ".join(words(9, s)) for s in range(12)]
    docs = [(i, "\n".join(shared[(i + k) % 12] if k % 2 else " ".join(words(9, 500 + 7 * i + k)) for k in range(6)), "s") for i in range(160)]
    docs += [(500 + i // 2, docs[i][1], "s") for i in range(40)]  # copies, and ids of two rows
    spark.createDataFrame(docs, DOCS).repartition(8, "doc_id").write.parquet(f"{tmp_root}/docs")
    table = spark.read.parquet(f"{tmp_root}/docs")
    splits(1)
    numbers, lines = placed(table, "row"), line_dedup.dedup_lines(table)
    first, warc_rows = simhash.keep_first(table), warc.records(table.withColumn("url", F.lit("u")), "doc_id", "url", "text")
    before = {(r.row, r.doc_id) for r in numbers.collect()}
    splits(16)
    assert table.rdd.getNumPartitions() > 4 and len(before) == 200 == len({r for r, _ in before})
    assert {(r.row, r.doc_id) for r in numbers.collect()} == before
    got = sorted((r.doc_id, r.text) for r in lines.collect())
    rows = {i: t for i, t, _ in docs if i < 500}
    want = dict(zip(sorted(rows), brute_lines([(i, rows[i]) for i in sorted(rows)])))
    assert [x for x in got if x[0] < 500] == sorted(want.items()) and all(t == "" or not t.strip() for i, t in got if i >= 500)
    kept = sorted(r.doc_id for r in first.collect())
    marks = {i: brute_fingerprint(t) for i, t in rows.items()}
    root, least = brute_components(set(marks.values()), lambda a, b: bin(a ^ b).count("1") <= 3), {}
    for i in sorted(marks):
        least.setdefault(root[marks[i]], i)
    assert kept == sorted(least.values())
    again = warc_rows.collect()
    assert sum(r.refers_record is not None for r in again) == 40 and {r.refers_record for r in again} - {None} <= {r.record for r in again}
    assert all(r.refers_page == r.page or r.page >= 500 for r in again if r.refers_record is not None)


def test_rows_of_other_frames_are_numbered_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "row long, t string")
    out = placed(rows.union(rows), "n")
    assert sorted(r.n for r in out.collect()) == sorted(r.n for r in out.collect()) and out.select("n").distinct().count() == 6
    assert placed(rows.limit(0), "n").count() == 0


# ---------------------------------------------------------------- 11

def brute_licenses(text, templates):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = []
    for t in templates:
        key = list(t.words[t.key_at:t.key_at + t.key_size])
        for i in range(len(w) - len(key) + 1):
            if w[i:i + len(key)] == key:
                same = sum(0 <= i - t.key_at + k < len(w) and w[i - t.key_at + k] == x for k, x in enumerate(t.words))
                found.append((t.label, t.base, i, same / len(t.words)))
    own = [f for f in found if f[1]]
    labels = lambda fs: ",".join(sorted({f[0] for f in fs}))
    return (len(w), len(own), min((f[2] for f in own), default=None), max((f[2] for f in own), default=None), labels(own), labels(found), max((f[3] for f in found), default=0.0))


def test_license_scan(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3."]
    texts = [None, "", "...", *lines, "\n".join(lines * 3), "under the MIT licence", "mit license the under", "Under\tTHE-mit_LICENSE under the mit license", "cc by nc" * 3, "cc by nc " * 400,
             "license " * 3000 + "under the mit license", "É under the ÉMIT license", "the worK is licensed", "under the mit Kicense", "x " * 5000 + lines[1], "GNU Lesser General Public License gnu general public license version 2",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of something", lines[0]]
    rows = [(i % 17, t, 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Labels int").repartition(3)
    again = license_scan._template("twice", "la la land la la", "la land la la")
    for templates in (license_scan.TEMPLATES, (*license_scan.TEMPLATES, again)):
        for n_rare in (1, 2, 9):
            out = license_scan.scan_licenses(df, templates=templates, n_rare=n_rare)
            assert out.columns == ["doc_id", "Labels", "n_words", "n_base", "first_word", "last_word", "base_labels", "_labels", "score"]
            assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((i, 7, *brute_licenses(t, templates))) for i, t, _ in rows)
    assert license_scan.scan_licenses(df.limit(0)).count() == 0
    land = spark.createDataFrame([(1, "La la land la la la land la la")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in license_scan.scan_licenses(land, templates=(again,)).collect()] == [brute_licenses("La la land la la la land la la", (again,))]
    spread = spark.createDataFrame([(i, lines[0]) for i in range(3000)], "doc_id long, text string")
    assert {tuple(r)[1:] for r in license_scan.scan_licenses(spread).collect()} == {brute_licenses(lines[0], license_scan.TEMPLATES)}


# ---------------------------------------------------------------- 12

def brute_negatives(rows, every=50):
    fine = [(i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, label, v) in enumerate(fine):
        if i % every:
            continue
        others = sorted((-dot(v, w), j, other == label) for m, (j, other, w) in enumerate(fine) if m != n)
        for score, j, _ in [x for x in others if x[2]][:5]:
            hits = [(s, k) for s, k, same in others if not same and 50 * -score <= 100 * -s <= 95 * -score][:3]
            out += [(i, j, rank, k, -score, -s) for rank, (s, k) in enumerate(hits, 1)]
    return sorted(out)


def test_hard_negatives(spark):
    r = np.random.default_rng(3)
    kind = "vec_id long, embedding array<float>, label int, anchor_id string"
    spread = [(i, [float(np.float32(x)) for x in r.normal(size=6)], int(r.integers(3)), "x") for i in range(700)]
    tied = [(i, [1.0, float(i % 2), 0.5], i % 4, "x") for i in range(400)] + [(i, [1.0, 0.0, 0.5], 1, "x") for i in range(0, 400, 50)]  # a third of all rows and more are one vector
    odd = [(None, [1.0], 1, None), (50, None, 1, None), (100, [1.0, None], 1, None), (150, [float("nan")], 1, None), (200, [float("inf"), 1.0], 1, None), (250, [1.0, 1.0], None, None),
           (300, [], 1, None), (350, [1.0], 1, None), (350, [1.0], 1, None), (400, [0.5, 9.0], 2, None), (-50, [0.7], 2, None), (7, [-1e6, 3.0], 9, None), (450, [2e6, 1.0, 1.0], 0, None), (451, [3.0], 0, None)]
    for rows, tile in ((spread, 100), (tied, 64), (spread + tied, 4096), (odd, 2), (odd[6:7], 9)):
        df = spark.createDataFrame(rows, kind).repartition(5)
        for block in (4096, 3):
            if block == 3 and rows is not tied:
                continue
            out = hard_negatives.mine_negatives(df, tile_rows=tile, block_rows=block, share=4)
            assert sorted(map(tuple, out.collect())) == brute_negatives([x[:3] for x in rows])
    assert hard_negatives.mine_negatives(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="63 bits"):
        hard_negatives.mine_negatives(spark.createDataFrame([(0, [3e15], 1), (1, [3e15], 2)], "vec_id long, embedding array<double>, label int")).count()


def test_boxes_hold_their_pages(spark):
    r = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(x) for x in r.normal(size=5)], 1) for i in range(900)], "vec_id long, embedding array<double>, label int")
    vectors = hard_negatives.valid_vectors(df)
    pages, size = hard_negatives.build_index(vectors, 200)
    table = pages.toArrow().combine_chunks()
    seen, a = [], r.integers(-300, 300, (20, 5))
    for batch in table.to_batches():
        for page, low, high in hard_negatives._pages(batch, size):
            seen += page.ids.tolist()
            down, up = hard_negatives._interval(a, low[None], high[None])
            scores = a @ page.vectors.T
            assert (scores >= down).all() and (scores <= up).all() and len(page.ids) <= hard_negatives.PAGE_ROWS
    assert sorted(seen) == list(range(900)) and table.num_rows > 14


# ---------------------------------------------------------------- 13

def brute_trie(rows):
    """Nodes of the trie of the rebuilt conversations, from rows (conv, turn, role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            r, t = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest(), r, t))
    turns = {c: [x[3:] for x in sorted(xs)] for c, xs in own.items()}
    built = {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(np.fmod(c, 5))
        built[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = {}
    for c, xs in built.items():
        for d in range(len(xs) + 1):
            members.setdefault(tuple(xs[:d]), []).append(c)
    out = {}
    for key in sorted(members, key=len, reverse=True):
        n, kids = len(members[key]), [k for k in members if len(k) == len(key) + 1 and k[:-1] == key] if len(members) < 3000 else None
        out[key] = [0, 0, (n - 1) * len(key[-1][1].encode()) if key else 0] if kids is None else [len(kids), sum(out[k][1] for k in kids) + (not kids), sum(out[k][2] for k in kids) + ((n - 1) * len(key[-1][1].encode()) if key else 0)]
    return sorted((min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs), *out[key], hashlib.sha256(",".join(str(c) for c in sorted(cs) if len(built[c]) == len(key)).encode()).hexdigest())
                  for key, cs in members.items())


def trie_rows(seed: int, n: int = 300):
    r = random.Random(seed)
    rows = [(r.choice([None, *range(-7, 60)]), r.choice([None, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]), r.choice(["user", "bot", None]), r.choice(["a", "é", None, "", "long " * 9])) for _ in range(n)]
    return rows + rows[:20] + [(900, i, "user", f"turn {i}") for i in range(150)] + [(901, i, "user", f"turn {i}") for i in range(120)] + [(c, i, "user", "same") for c in range(1000, 1060) for i in range(9)]


@pytest.mark.parametrize(("shard_rows", "most_held", "blob_ids"), [(1 << 12, 1 << 20, 1 << 13), (1, 1, 2), (13, 4, 3)])
def test_conversation_trie(spark, shard_rows, most_held, blob_ids):
    rows = trie_rows(shard_rows)
    df = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, depth string").repartition(7)
    out = conversation_trie.conversation_trie(df, shard_rows=shard_rows, most_held=most_held, blob_ids=blob_ids)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute_trie(rows), key=str)


def test_conversation_trie_of_few_rows(spark):
    kind = "conv_id long, turn long, role string, text string"
    for rows in ([], [(None, 1, "a", "b")], [(3, None, None, None)], [(11, 0, "a", "b")] * 3):
        df = spark.createDataFrame(rows, kind)
        assert sorted(map(tuple, conversation_trie.conversation_trie(df).collect()), key=str) == sorted(brute_trie(rows), key=str)


def test_spilling_queue():
    r = np.random.default_rng(5)
    for most in (1, 10, 1 << 20):
        queue, sent = spilling_queue.SpillingQueue(most), {}
        for _ in range(30):
            level, node, values = r.integers(0, 4, 25), r.integers(-9, 9, 25), r.integers(0, 99, (25, 3))
            queue.push(level, node, values)
            for lv, nd, v in zip(level.tolist(), node.tolist(), values):
                sent[lv, nd] = sent.get((lv, nd), 0) + v
        for lv in (3, 2, 1, 0):
            for first, upto in ((-99, -3), (-3, -3), (-3, 2), (2, 99)):
                got = queue.pop(lv, upto)
                want = {nd: v.tolist() for (l2, nd), v in sent.items() if l2 == lv and first < nd <= upto}
                assert {int(x[0]): x[1:].tolist() for x in got} == want and (np.diff(got[:, 0]) > 0).all()
        assert len(queue) == 0
