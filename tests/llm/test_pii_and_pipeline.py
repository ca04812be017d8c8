"""Personal data against plain patterns, found identifiers, and the pipeline's stages on a small corpus."""

import hashlib
import math
import random
import re

import pytest

import corpus_pipeline
from matchweave.llm import pii
from matchweave.llm.common import table
from tests.llm.helpers import ODD, SCHEMA, odd, prose

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    out = [(m.start(), k, kind, m.end()) for k, (kind, form) in enumerate(FORMS.items()) for m in re.finditer(form, text or "") if good(kind, m[0])]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]


def texts():
    dice = random.Random(8)
    shapes = ["a.b@c.de", "x@y", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "001.002.003.255", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "+1 (017) 555-7713", "+12", "++49 30 1234567.",
              "9807915762804490", "4845168114407329", "12.5", "é4a@b.cc", "+1.2.3.4.5.6.7.8.9.0"]
    out = ["".join(dice.choices("0123456789.@+- (ab", k=dice.randint(1, 80))) for _ in range(300)]
    return out + [" ".join(dice.choices(shapes, k=6)) for _ in range(80)] + shapes + [t for _, t in ODD]


def test_fixed_forms(spark):
    rows = list(enumerate(texts()))
    found = {r.doc_id: r for r in pii.digest(pii.personal_data(spark.createDataFrame(rows, SCHEMA))).collect()}
    for k, text in rows:
        expected = plain(text)
        assert found[k].base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        assert [s for s in found[k].spans.split(",") if s and not s.startswith("like_")] == expected
        assert found[k].n_email == sum(s.startswith("email") for s in expected)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 100_000):
        pii.candidates(text, pii.base_spans(text))


def contextual(spark):
    """Addresses behind 'write to', a few written in a way that the fixed form misses; numbers elsewhere."""
    dice = random.Random(6)
    docs = [(k, f"{prose(dice, 5)} please write to me{k}@host{k}.org soon {prose(dice, 5)}") for k in range(60)]
    docs += [(100 + k, f"{prose(dice, 3)} please write to user{k}@intranet soon {prose(dice, 3)}") for k in range(3)]
    docs += [(200, "later user1@intranet appears alone"), *[(300 + k, f"{prose(dice, 4)} year 19{k} was long {prose(dice, 4)}") for k in range(10, 60)]]
    return spark.createDataFrame(docs, SCHEMA).repartition(5), docs


def test_patterns_find_unseen_identifiers(spark):
    docs, rows = contextual(spark)
    text = dict(rows)
    found = {r.doc_id: [(s.kind, text[r.doc_id][s.start : s.end]) for s in r.spans if s.place >= 4] for r in pii.personal_data(docs).collect()}
    assert all(found[100 + k] == [("like_email", f"user{k}@intranet")] for k in range(3))
    assert found[200] == [("like_email", "user1@intranet")]
    assert not any(found[k] for k in [*range(60), *range(310, 360)])


def plain_discovered(places):
    """The rounds of ``discovered`` in plain Python."""
    edges = {(p["instance"], q) for p in places for q in p["patterns"]}
    known = {}
    for p in places:
        if p["kind"] is not None:
            known[p["instance"]] = (min(p["kind"], known.get(p["instance"], (p["kind"],))[0]), 1.0)
    seeds, kinds = set(known), pii.KINDS + pii.MORE
    while True:
        sure = {}
        for pattern in {q for _, q in edges}:
            own = [i for i, q in edges if q == pattern]
            sums = {k: sum(known[i][1] for i in own if i in known and known[i][0] == k) for k in kinds}
            best = max(sums.values())
            if best >= pii.SUPPORT and best >= pii.CONFIDENT * len(own):
                sure[pattern] = (best / len(own), next(k for k in kinds if sums[k] == best))
        new = {}
        for i in {i for i, q in edges if q in sure} - set(known):
            near = [sure[q] for j, q in edges if j == i and q in sure]
            score = 1 - math.prod(max(1 - c, 0.02) for c, _ in near)
            if score >= pii.ACCEPTED:
                new[i] = (max(near)[1], score)
        if not new:
            return {i: v for i, v in known.items() if i not in seeds}
        known |= new


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_graph_against_plain_python(spark, seed):
    dice = random.Random(seed)
    instances = [f"i{k}" for k in range(60)]
    places = [{"instance": dice.choice(instances), "kind": None, "patterns": [f"p{dice.randrange(12)}", f"q{dice.randrange(40)}"]} for _ in range(300)]
    kind = {i: dice.choice(["email", "phone", "secret"]) for i in dice.sample(instances, 35)}
    for p in places:
        group = int(p["patterns"][0][1:])
        if group < 6 and p["instance"] not in kind and dice.random() < 0.8:
            p["patterns"] = ["q99"]
        p["kind"] = kind.get(p["instance"])
    rows = [(p["instance"], p["kind"], p["patterns"]) for p in places]
    found = {r.instance: (r.kind, r.score) for r in pii.discovered(spark.createDataFrame(rows, "instance string, kind string, patterns array<string>")).collect()}
    plain = plain_discovered(places)
    assert {i: k for i, (k, _) in found.items()} == {i: k for i, (k, _) in plain.items()}
    assert all(found[i][1] == pytest.approx(plain[i][1]) for i in plain)


def test_rounds_until_nothing_new(spark):
    """Each pattern becomes confident only by what the round before has found."""
    rows, known = [], [f"seed{k}" for k in range(9)]
    for step in range(6):
        fresh = [f"n{step}_{k}" for k in range(9)]
        rows += [(x, "email" if x.startswith("seed") else None, [f"p{step}"]) for x in known]
        rows += [(f"s{step}_{k}", "email", [f"p{step}"]) for k in range(200)]
        rows += [(x, None, [f"p{step}"]) for x in fresh]
        known = fresh
    places = spark.createDataFrame(rows, "instance string, kind string, patterns array<string>")
    found = {r.instance for r in pii.discovered(places).collect()}
    assert found == set(plain_discovered([dict(zip(("instance", "kind", "patterns"), r)) for r in rows])) and {f"n{step}_0" for step in range(6)} <= found


def test_numbers_over_spaces_long_identifiers_and_secrets(spark):
    dice = random.Random(4)
    rows = [f"{prose(dice, 4)} my number is +1 ({200 + k}) 555-38{k % 90 + 10} thanks {prose(dice, 3)}" for k in range(80)]
    rows += ["so my number is (743) 555 3824 thanks a lot", f"and my number is {'12345678' * 25} thanks again"]
    rows += [f"{prose(dice, 3)} token = \"{dice.getrandbits(160) | 1 << 159:040x}\" {prose(dice, 2)}" for _ in range(40)]
    rows += ["here token = \"zk_live_77aa-X9\" is set", f"plain {'7' * 40} and {'a' * 40}", "in 2019 we had 12 of 13"]
    docs = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    found = {r.doc_id: {s.kind: rows[r.doc_id][s.start : s.end] for s in r.spans} for r in pii.personal_data(docs).collect()}
    assert all("phone" in found[k] for k in range(80))
    assert found[80] == {"like_phone": "(743) 555 3824"} and found[81] == {"like_phone": "12345678" * 25}
    assert all(len(found[82 + k]["secret"]) == 40 for k in range(40)) and found[122] == {"like_secret": "zk_live_77aa-X9"}
    assert found[123] == {} and found[124] == {}


def test_contexts_are_whole_words():
    long = "w" * 500
    assert pii._before(f"a {long} {long} x", len(f"a {long} {long} "), 2) == [long, long]
    assert pii.patterns(f"x {long} 5 {long}y z", 503, 504)[1].startswith("1 sha256:")
    assert pii._after("  ", 0) == [] and pii._before("", 0, 2) == []


def test_scrubbing_keeps_all_else(spark):
    docs, rows = contextual(spark)
    wide = docs.selectExpr("doc_id", "text", "length(text) n_chars", "1 as spans", "'x' as text_hash").union(spark.createDataFrame([(None, None, None, 1, "x")], "a bigint, b string, c int, d int, e string"))
    found = {r.doc_id: r for r in pii.scrubbed(wide).collect()}
    assert len(found) == len(rows) + 1 and set(pii.scrubbed(wide).columns) == set(wide.columns)
    assert "<EMAIL> soon" in found[1].text and "<LIKE_EMAIL> soon" in found[101].text and found[310].text == dict(rows)[310]
    assert found[1].n_chars == len(found[1].text) and found[None].text is None


def test_odd_tables(spark):
    assert pii.personal_data(odd(spark, extra=True)).count() == len(ODD)
    assert pii.personal_data(odd(spark).limit(0)).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good prose, junk, copies, near copies, leaks and addresses."""
    root = tmp_path_factory.mktemp("corpus")
    dice = random.Random(12)
    words = ["".join(dice.choices("abcdefghijkl", k=5)) for _ in range(4000)]
    item = prose(dice, 30, words)
    docs, labels = [], []
    for k in range(240):
        body = "\n".join(prose(dice, dice.randint(5, 45), words) + dice.choice([".", "", ", 12."]) for _ in range(dice.randint(3, 9)))
        if k % 8 == 3:
            body = body.upper().replace(" ", "!! ")
        labels.append((k, int(k % 8 != 3), 0))
        docs.append([k, body])
    docs += [[500, docs[0][1]], [501, docs[1][1] + " end"], [502, docs[4][1] + " " + item], [503, docs[5][1].replace(".", " .", 1) + "\nmail a.b@c.org now"], [504, docs[0][1]]]
    rows = [(k, t, "en", f"s{k % 3}", len(t)) for k, t in docs]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_every_stage_keeps_what_it_should(spark, folder):
    docs = table(spark, folder, "documents")
    clean = {k for k in range(240) if k % 8 != 3}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    good = corpus_pipeline.good_quality(spark, docs, folder)
    assert ids(good) == clean | {500, 501, 502, 503, 504} and good.columns == docs.columns
    single = corpus_pipeline.one_of_each(spark, good, folder)
    assert not ids(single) & {500, 504} and ids(single) >= clean - {1, 4, 5} and single.columns == docs.columns
    free = corpus_pipeline.uncontaminated(spark, docs, folder)
    assert ids(free) == ids(docs) - {502} and free.columns == docs.columns
    scrubbed = corpus_pipeline.without_personal_data(spark, docs, folder)
    assert scrubbed.columns == docs.columns and scrubbed.count() == docs.count()
    changed = {r.doc_id for r in scrubbed.join(docs.withColumnRenamed("text", "before"), "doc_id").where("text <> before").select("doc_id").collect()}
    assert changed == {503}


def test_the_whole_pipeline(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    found = {r.doc_id for r in rows}
    assert len(rows) == len(found) and all(r.decoded and r.ids for r in rows)
    assert not found & ({k for k in range(240) if k % 8 == 3} | {500, 502, 504})
    assert found >= {k for k in range(240) if k % 8 != 3} - {1, 4, 5}


def test_unlike_texts_under_one_id_both_stay(spark, folder):
    dice = random.Random(9)
    words = [f"w{k}" for k in range(900)]
    one, two, three = (prose(dice, 60, words) for _ in range(3))
    rows = [(1, one), (1, two), (2, one), (3, two), (4, three), (1, one), (None, three), (None, prose(dice, 60, words)), (None, prose(dice, 60, words))]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = sorted(((r.doc_id or 0), r.text) for r in corpus_pipeline.one_of_each(spark, docs, folder).collect())
    assert kept == sorted([(1, one), (1, two), (4, three), (0, rows[7][1]), (0, rows[8][1])])


def test_without_labels_no_document_goes(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(9)], SCHEMA)
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(3, 0, 0)]):
        spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        assert corpus_pipeline.good_quality(spark, docs, str(tmp_path)).count() == 9


def test_stages_on_odd_rows(spark, folder):
    docs = odd(spark).selectExpr("doc_id", "text", "'en' lang", "cast(null as string) source", "cast(null as bigint) n_chars", "1 as ids")
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, folder)
        assert out.columns == docs.columns
        out.collect()
        assert step(spark, docs.limit(0), folder).collect() == []
    assert corpus_pipeline.encoded(spark, docs, folder).count() == len(ODD)
