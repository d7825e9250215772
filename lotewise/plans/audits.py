"""The quick test before a whole run, and the accuracy audit after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotewise.operators.audit import ERROR, accuracy_by_field, reconcile
from lotewise.operators.checks import canary_sample, field_checks, random_sample, verdict
from lotewise.operators.load import Check, check_table
from lotewise.operators.quality import quality_of_table
from lotewise.plans import form
from lotewise.plans.full_load import REPORT_TABLE, SAMPLE_TABLE, Extracted, extract
from lotewise.schemas import REPORT_KEY, SAMPLE_KEY

KEY = "codigo_laudo"


def quick_test(
    files: DataFrame,
    words: DataFrame,
    rules: dict[str, Column] | None = None,
    limit: float = 0.05,
    n: int = 60,
    recency: str = "modified_at",
) -> tuple[DataFrame, DataFrame, Extracted]:
    """D7, then extraction of the sample alone, D3 and D8; writes nothing.

    Returns the problems per report, the verdict and what was read. Each rule (the form's own list
    unless others are given) may hit at most the share `limit` of the sample.
    """
    rules = form.report_rules() if rules is None else rules
    sample = canary_sample(files, KEY, recency, n).select(KEY)
    read = extract(words.join(sample, KEY, "left_semi"))
    problems = field_checks(read.reports, KEY, rules)
    checks = [
        Check(name, F.coalesce(bad, F.lit(False)), limit) for name, bad in rules.items()
    ]
    return problems, verdict(check_table(read.reports, checks)), read


def accuracy_audit(
    stored: DataFrame,
    printed: DataFrame,
    second: DataFrame,
    fields: dict[str, str],
    sources: Sequence[str],
    n: int | None = 500,
    key: str = KEY,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """E1 → E2 → E3: (hit rate per field, inconsistent and wrong values, verdict).

    Only the drawn reports meet the second source; `n=None` takes all of them.
    """
    drawn = random_sample(stored, key, n)
    compared = reconcile(drawn, printed, second, [key], fields, sources)
    rates = accuracy_by_field(compared)
    wrong = compared.filter("outcome <> 'match'")
    judged = verdict(
        check_table(compared, [Check("extraction errors", F.col("outcome") == ERROR, 0.02)])
    )
    return rates, wrong, judged


def quality_of_tables(reports: DataFrame, samples: DataFrame) -> DataFrame:
    """E7 over both stored tables, each read once: (table, section, check, key, value).

    Rules are the form's own lists; appraisal and sample values are compared within their type.
    """
    parts = {
        REPORT_TABLE: quality_of_table(reports, REPORT_KEY, form.report_rules(), {"valor_avaliacao": ["tipo"]}),
        SAMPLE_TABLE: quality_of_table(samples, SAMPLE_KEY, form.sample_rules(), {"valor": ["tipo"]}),
    }
    first, second = (part.select(F.lit(name).alias("table"), "*") for name, part in parts.items())
    return first.unionByName(second)
