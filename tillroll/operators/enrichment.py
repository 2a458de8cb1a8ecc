"""Review classification: by keyword rules inside the JVM, or by a model inside the partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import in_domain, json_objects, whole_word, whole_words_in
from tillroll.operators.model_calls import TRIES, ask

# The issue types, and the answer that stands for "nothing recognised".
ISSUE_TYPES = (
    "shipping_delay", "product_quality", "wrong_item",
    "customer_service", "packaging_damage", "none",
)
DEFAULTS = {"sentiment": "neutral", "issue_type": "none", "urgency": "low"}

# Words of the built-in rules: a general lexicon of retail complaints. The first issue type with a hit wins.
ISSUE_WORDS = {
    "packaging_damage": ("damaged", "damage", "crushed", "dented", "dent", "torn", "leaking", "packaging"),
    "wrong_item": ("wrong item", "wrong product", "wrong size", "wrong color", "mixed up", "not what i ordered"),
    "customer_service": ("customer service", "support", "helpdesk", "unhelpful", "rude", "impolite", "no reply"),
    "shipping_delay": ("late", "delay", "delayed", "overdue", "slow", "shipping", "waited", "waiting"),
    "product_quality": ("broke", "broken", "defective", "faulty", "flimsy", "cheap", "poor quality", "useless"),
}
NEGATIVE_WORDS = ("disappointed", "disappointing", "terrible", "awful", "horrible", "worst", "worthless", "bad")
POSITIVE_WORDS = ("happy", "great", "good", "excellent", "love", "recommend", "perfect", "satisfied")
URGENT_WORDS = ("urgent", "immediately", "asap", "refund", "unsafe", "dangerous", "lawyer")

RULE_WORDS = (*(word for words in ISSUE_WORDS.values() for word in words), *NEGATIVE_WORDS, *POSITIVE_WORDS, *URGENT_WORDS)

MODEL_ANSWER = "struct<sentiment: string, issue_type: string, urgency: string>"

# A scorer is made once per partition and answers a batch of texts with a batch of raw answers.
Scorer = Callable[[list[str]], Iterable[str]]


def _first_issue(text: Column) -> Column:
    rules = [(whole_word(text, words), issue) for issue, words in ISSUE_WORDS.items()]
    chain = F.when(rules[0][0], F.lit(rules[0][1]))
    for found, issue in rules[1:]:
        chain = chain.when(found, F.lit(issue))
    return chain.otherwise(F.lit(DEFAULTS["issue_type"]))


def classify_by_rules(reviews: DataFrame) -> DataFrame:
    """Sentiment, issue type and urgency by the words above; each text is looked through once, the rules see what stood there."""
    text = F.col("hits")
    found = reviews.select("review_id", whole_words_in(F.lower("review_text"), RULE_WORDS).alias("hits")).select(
        "review_id",
        _first_issue(text).alias("issue_type"),
        F.coalesce(whole_word(text, NEGATIVE_WORDS), F.lit(False)).alias("bad"),
        F.coalesce(whole_word(text, POSITIVE_WORDS), F.lit(False)).alias("good"),
        F.coalesce(whole_word(text, URGENT_WORDS), F.lit(False)).alias("urgent"),
    )
    complaint = F.col("bad") | (F.col("issue_type") != "none")
    return found.select(
        "review_id",
        F.when(complaint, "negative").when(F.col("good"), "positive").otherwise("neutral").alias(
            "sentiment"
        ),
        "issue_type",
        F.when(complaint & F.col("urgent"), "high")
        .when(complaint, "medium")
        .otherwise("low")
        .alias("urgency"),
    )


def parse_enrichment(answers: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Turn raw model answers into checked rows.

    Text around the JSON object is allowed. What cannot be parsed, is missing or is null takes its
    default; only the issue type is held against its list.
    """
    found = answers.select("review_id", json_objects(F.col(raw_col), MODEL_ANSWER).alias("found"))
    parsed = found.selectExpr("review_id", "if(size(found) = 1, found[0], null) as answer")
    return parsed.select(
        "review_id",
        F.coalesce("answer.sentiment", F.lit(DEFAULTS["sentiment"])).alias("sentiment"),
        in_domain(F.col("answer.issue_type"), ISSUE_TYPES, DEFAULTS["issue_type"]).alias(
            "issue_type"
        ),
        F.coalesce("answer.urgency", F.lit(DEFAULTS["urgency"])).alias("urgency"),
    )


def model_answers(reviews: DataFrame, make_scorer: Callable[[], Scorer], tries: int = TRIES) -> DataFrame:
    """(review_id, raw, error): a model's raw answers, asked in Arrow batches with one client per partition."""
    asked = ask(reviews, "review_id", "review_text", make_scorer, "string", tries)
    return asked.withColumnRenamed("answer", "raw")


def strict(asked: DataFrame, answer: str) -> Column:
    """The answer; an error where there is none because of one."""
    failed = F.raise_error(F.concat(F.lit("the model failed on a text: "), F.col("error"))).cast(asked.schema[answer].dataType)
    return F.when(F.col("error").isNotNull(), failed).otherwise(F.col(answer))


def enrich_reviews(
    reviews: DataFrame, make_scorer: Callable[[], Scorer] | None = None
) -> DataFrame:
    """Sentiment, issue type and urgency per review; by rules unless a model is plugged in, which must answer all."""
    if make_scorer is None:
        return classify_by_rules(reviews)
    asked = model_answers(reviews, make_scorer)
    return parse_enrichment(asked.select("review_id", strict(asked, "raw").alias("raw")))
