"""Table checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repopulse.checks.activity_queries import main
from repopulse.checks.cleaning_queries import RAW_DISCUSSIONS, raw_discussions
from repopulse.checks.registry import query
from repopulse.checks.tables import MAIN, main_discussions
from repopulse.operators import quality

_COUNTS = {
    "models.total_rows": "SELECT count(*) FROM model_repos",
    "discussions.total_rows": "SELECT count(*) FROM discussions",
    "models.missing_model_id": "SELECT count(*) FROM model_repos WHERE model_id IS NULL",
    "discussions.missing_repo_id": "SELECT count(*) FROM discussions WHERE repo_id IS NULL",
    "discussions.missing_created_at": "SELECT count(*) FROM discussions WHERE created_at IS NULL",
    "discussions.duplicate_per_repo": "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM"
    " (SELECT count(*) AS n FROM discussions GROUP BY repo_id, hf_discussion_num)",
    "discussions.invalid_status_values": "SELECT count(*) FROM discussions WHERE status IS NULL OR status NOT IN ('open', 'closed')",
    "discussions.closed_before_created": "SELECT count(*) FROM discussions WHERE closed_at < created_at",
    "models.negative_likes": "SELECT count(*) FROM model_repos WHERE likes < 0",
    "models.negative_downloads": "SELECT count(*) FROM model_repos WHERE downloads < 0",
}
CHECKS = (
    MAIN.rstrip()
    + ", checks AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, ({sql}) AS offending_rows, '{quality.CHECKS[name]}' AS description"
        for name, sql in _COUNTS.items()
    )
    + ")\n"
)


@query("q11_checks", CHECKS + "SELECT * FROM checks")
def q11(spark: SparkSession, folder: str) -> DataFrame:
    return quality.table_checks(*main(spark, folder))


def _single(number: int, name: str) -> None:
    @query(f"q{number:02d}_{name.split('.')[1]}" + ("_discussions" if name == "discussions.total_rows" else ""),
           CHECKS + f"SELECT * FROM checks WHERE check_name = '{name}'")
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return quality.table_checks(*main(spark, folder, name.endswith("closed_before_created")), (name,))


for _number, _name in enumerate(quality.CHECKS, 1):
    _single(_number, _name)


@query("q12_validator", RAW_DISCUSSIONS + """
SELECT count(*) FILTER (WHERE model_id IS NULL) AS missing_model_id,
       count(*) FILTER (WHERE created_at IS NULL) AS missing_created_at,
       (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM drows GROUP BY model_id, hf_discussion_num))
         AS duplicate_discussions,
       count(*) FILTER (WHERE status IS NULL OR status NOT IN ('open', 'closed')) AS invalid_status_values
FROM drows""")  # fmt: skip
def q12(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validate_discussions(raw_discussions(spark, folder))


_FAILED = "check_name NOT IN ('models.total_rows', 'discussions.total_rows') AND offending_rows > 0"


@query("q13_summary", CHECKS + f"SELECT count(*) AS failed_checks, count(*) = 0 AS all_passed FROM checks WHERE {_FAILED}")
def q13(spark: SparkSession, folder: str) -> DataFrame:
    return quality.summary(quality.table_checks(*main(spark, folder)))


@query("b19_failed_checks", CHECKS + f"SELECT * FROM checks WHERE {_FAILED}")
def b19(spark: SparkSession, folder: str) -> DataFrame:
    return quality.failures(quality.table_checks(*main(spark, folder)))


@query("g03_duplicate_count", MAIN + f"SELECT ({_COUNTS['discussions.duplicate_per_repo']}) AS duplicate_rows")
def g03(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_count(main_discussions(spark, folder, closed_at=False), ["repo_id", "hf_discussion_num"])
