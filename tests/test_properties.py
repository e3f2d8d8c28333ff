"""Property tests: CSV round trip and review classification against plain-Python models."""

import datetime as dt
from decimal import Decimal

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.text import stop_words
from strata.operators import classified_review, export_csv
from strata.schemas import USER_PURCHASE
from strata.session import scratch_path
from strata.sources import read_csv_typed

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# text that stresses CSV: delimiters, quotes, both newline kinds, blanks, non-ASCII letters
tricky = st.text(alphabet=st.sampled_from(list('ab ,"\n\r\téß€Ω日 ')), max_size=12)
maybe = lambda s: st.one_of(st.none(), s)

rows = st.lists(st.tuples(
    maybe(st.text(alphabet="0123456789AZ ,\"", max_size=10)),
    maybe(tricky.map(lambda t: t[:20])),
    maybe(tricky),
    maybe(st.integers(-2**31, 2**31 - 1)),
    maybe(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1))),
    maybe(st.decimals(min_value=Decimal("-99999.999"), max_value=Decimal("99999.999"), places=3)),
    maybe(st.integers(-2**31, 2**31 - 1)),
    maybe(tricky.map(lambda t: t[:20])),
), min_size=1, max_size=40)


@SETTINGS
@given(rows)
def test_csv_round_trip_is_lossless(spark, data):
    df = spark.createDataFrame(data, USER_PURCHASE)
    path = export_csv(df, scratch_path(spark, "prop_csv"))
    back = [tuple(r) for r in read_csv_typed(spark, path).collect()]
    key = lambda r: repr(r)
    assert sorted(back, key=key) == sorted(data, key=key)


WORDS = ["good", "the", "gut", "bien", "and", "café"]
text = st.text(alphabet=st.sampled_from(list("goodthe gutbiencafé AND,.!-1\nÉ")), max_size=40)


def model(t, words):
    toks = [x for x in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if x]
    toks = [x for x in toks if x not in set(stop_words())]
    return int(any(x in set(words) for x in toks))


@SETTINGS
@given(st.lists(maybe(text), min_size=1, max_size=30))
def test_classification_matches_model(spark, texts):
    reviews = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)],
                                    "customer_id bigint, review_id bigint, review_text string")
    got = {r.review_id: r.positive_review for r in classified_review(reviews, WORDS).collect()}
    assert got == {i: model(t, WORDS) for i, t in enumerate(texts)}
