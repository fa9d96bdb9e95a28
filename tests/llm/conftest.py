import gc
import random

import pytest

from newsfold.llm.shipping import ship

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, n_words string, `row` string"


@pytest.fixture(scope="session")
def llm_spark(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="package", autouse=True)
def nothing_stays_cached(spark):
    """What tests of this package cache is dropped after them; a plan of ``test_merge`` takes nearly all memory in one task."""
    yield
    spark.catalog.clearCache()
    gc.collect()
    spark._jvm.System.gc()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows and columns that operators could mistake for their own."""
    pick = random.Random(11)
    words = ["vel", "ora", "Time's", "naïve", "zwölf", "12ab", "été", "x", "—", "日本語", "ka", "lumo"]
    texts = [" ".join(pick.choice(words) for _ in range(pick.choice([0, 1, 4, 5, 12, 60, 300]))) for _ in range(60)]
    shared = " ".join(f"w{pick.randrange(10**6)}" for _ in range(90))
    texts += [f"{texts[k]}\n{shared}\n{texts[k + 1]}" for k in range(6)]
    near = [f"n{k}" for k in range(120)]
    texts += [" ".join([*near[:at], "changed", *near[at + 1 :]]) for at in (3, 40, 40, 77, 119)]
    texts += [None, None, "", "", "   \n\t ", "a" * 30_000, "word " * 9_000, "line one\nline one\nline one\n", "\ufeff\u00a0\u3000", "<|endoftext|> x"]
    texts += ["$ # % & * " * 10, "Released under the MIT License.\nbody text follows here", "x\nReleased under the MIT\nLicense.\n\nmore"]
    rows = [(at, text, None if at % 7 == 0 else "en", None if at % 5 == 0 else f"s{at % 3}", None, "d", "w", "r") for at, text in enumerate(texts)]
    rows += [rows[0], rows[3], rows[3], (None, texts[5], None, None, 1, None, None, None), (None, None, "en", "s1", 1, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(llm_spark, odd_rows):
    return llm_spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)
