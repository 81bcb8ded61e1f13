import functools
import hashlib
import math
import random
import re
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import secrets

KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, spans int, kind string")


def word(rnd, alphabet, n):
    return "".join(rnd.choice(alphabet) for _ in range(n))


WORDS = (
    "render widget user_name the connection handler-index of maximum retry_count max v2 timeout milliseconds 1789 2024 10 between every server request "
    "response parameter configuration default_value message length because another version_number different example temporary "
    "directory available identifier transaction performance environment variable documentation application memory_usage statistics"
).split()


def training_rows():
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        text = " ".join(rnd.choice(WORDS) for _ in range(60))
        rows.append((i, text + f" password={word(rnd, '0123456789abcdefghijkLMNOPQRSTUVWXYZ', 20)} end"))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    return secrets.train(docs_of(spark, training_rows()))


def folded(string):
    return re.sub("[+/_.=-]", " ", re.sub("[1-9]", "0", string.lower()))


def plain_models(rows):
    """The two models, the ratio of a string and the threshold by dicts."""
    random_, ordinary = Counter(), Counter()
    for _, text in rows:
        random_.update(m[2] for m in ASSIGN.finditer(text or "") if len(m[2]) >= 6)
        rest = re.sub("[0-9a-f]{24,}", " ", re.sub("AKIA[A-Z0-9]+", " ", ASSIGN.sub(" ", text or "")))
        ordinary.update(re.findall("[A-Za-z0-9]{3,}", rest))

    def conditional(strings):
        pairs, total = Counter(), Counter()
        for s, n in strings.items():
            for a, b in zip(" " + folded(s), folded(s)):
                pairs[a, b] += n * (b != " ")
                total[a] += n * (b != " ")
        return lambda a, b: math.log((pairs[a, b] + 0.5) / (total[a] + 0.5 * secrets.ALPHABET))

    p, q = conditional(random_), conditional(ordinary)

    @functools.cache
    def ratio(string):
        f = folded(string)
        return sum(max(-3, min(3, p(a, b) - q(a, b))) for a, b in set(zip(" " + f, f)) if b != " ") / len(f)

    r = [ratio(s) for s in random_.elements()]
    o = [ratio(s) for s in ordinary.elements() if len(s) >= 8]
    (m, d), (k, e) = ((statistics.fmean(x), statistics.pstdev(x)) for x in (r, o))
    return ratio, max((m * e + k * d) / (d + e), k + 4 * e, 0.5)


def test_ratios_and_threshold_equal_plain_counting(spark, trained):
    ratio, least = plain_models(training_rows())
    assert trained.least == pytest.approx(least, abs=1e-3)
    rnd = random.Random(4)
    strings = [word(rnd, "abcXYZ019_-/+", 20) for _ in range(40)] + ["retry_count_timeout", "a" * 30]
    rows = spark.createDataFrame([(s,) for s in strings], "s string").select("s", secrets._ratio(F.col("s"), trained.ratios).alias("r")).collect()
    assert all(r.r == pytest.approx(ratio(r.s), abs=1e-3) for r in rows)


def test_letters_alone_are_found_and_odd_identifiers_are_not(spark, trained):
    rnd = random.Random(12)
    letters = [word(rnd, "abcdefghijklmnopqrstuvwxyz", 40) for _ in range(50)]
    plain = ["MAX_RETRY_COUNT_v2_timeout_ms_10", "a" * 20 + "1", "0" * 20, "configuration_directory", "-" * 40, "documentationapplication"]
    rows = [(i, f"see {s} here") for i, s in enumerate(letters + plain)]
    got = {r.doc_id: r.spans for r in secrets.report(secrets.find_secrets(docs_of(spark, rows), trained)).collect()}
    assert sum(got[i] == "random:4:44" for i in range(50)) >= 49
    assert [got[50 + i] for i in range(len(plain))] == [""] * len(plain)


def test_base_spans_equal_plain_patterns(spark, trained):
    rnd = random.Random(2)
    parts = ["token", "TOKEN: ", "secret", " = ", "'", '"', "api_key", "ApiKey=", "passwd:", "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", " ", "é", "\x01", "\x02", "日本", "😀", "\n", "ſecret=abcdefgh", "toKen=abcdefgh", "=", "x"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "token: token: abcdefgh"), (5, "token=abcdefgh"), (5, "token=abcdefgh"), (None, "secret:'abcdefgh'")]
    docs = docs_of(spark, rows)
    got = secrets.report(secrets.find_secrets(docs, trained)).collect()
    want = []
    for doc_id, text in rows:
        found = base(text or "")
        kinds = [k for _, k, _ in found]
        written = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in found)
        want.append((doc_id, *[kinds.count(k) for k in range(3)], hashlib.sha256(written.encode()).hexdigest()))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    for r in got:
        for one in filter(None, r.spans.split(",")):
            assert one.split(":")[0] in secrets.KINDS


def test_model_adds_random_strings_and_leaves_identifiers(spark, trained):
    rnd = random.Random(11)
    rows, planted = [], {}
    for i in range(60):
        if i % 2:
            s = "k9" + word(rnd, "0123456789abcdefghijkLMNOPQRSTUVWXYZ", 30)
            text = f"😀 the key {s} of widget"
            planted[i] = f"random:{text.index(s)}:{text.index(s) + len(s)}"
        else:
            text = "the user_name_handler-index2 connection widget_render_v2 4041894974608795"
        rows.append((i, text))
    got = {r.doc_id: r.spans for r in secrets.report(secrets.find_secrets(docs_of(spark, rows), trained)).collect()}
    assert sum(got[i] == planted.get(i, "") for i in got) >= 58
    assert all(got[i] == "" for i in range(0, 60, 2))


def test_added_spans_never_touch_base_ones(spark, trained):
    value = "q8ZX" + word(random.Random(3), "0123456789abcdefghijkLMNOPQRSTUVWXYZ", 28)
    got = secrets.report(secrets.find_secrets(docs_of(spark, [(1, f"token={value} {value}")]), trained)).first()
    assert got.n_assign == 1
    assert got.spans == f"assign:0:{6 + len(value)},random:{7 + len(value)}:{7 + 2 * len(value)}"


def test_without_findings_nothing_is_random(spark):
    docs = docs_of(spark, [(1, "plain words q8ZXq8ZXq8ZXq8ZX0123"), (2, None)])
    ratios = secrets.train(docs)
    assert [r.spans for r in secrets.report(secrets.find_secrets(docs, ratios)).collect()] == ["", ""]
    empty = docs.limit(0)
    assert secrets.find_secrets(empty, secrets.train(empty)).collect() == []


def test_long_text_with_many_matches(spark, trained):
    text = "token=abcdefgh " * 20_000 + "f" * 100_000
    got = secrets.report(secrets.find_secrets(docs_of(spark, [(1, text)]), trained)).first()
    assert (got.n_assign, got.n_hex) == (20_000, 1)


def test_main_path_has_no_python(spark, trained):
    plan = secrets.find_secrets(docs_of(spark, [(1, "a")]), trained)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
