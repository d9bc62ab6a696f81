"""The minimum decision path: frame, contract, split, scorecard, threshold choice."""

from ..operators.contracts import Rule, fail_fast, out_of_range
from ..operators.metrics import threshold_table
from ..operators.policy import mark_selected
from ..operators.scoring import FULL, score
from ..operators.splits import stratified_split
from ..session import staged
from ..sources.frames import contacts
from .base import SPLITS, query, sweep_sql


@query(
    "flagship_threshold_choice",
    SPLITS
    + f""", sweep AS ({sweep_sql("(SELECT * FROM splits WHERE split = 'validation' AND age BETWEEN 18 AND 100) AS v")})
SELECT *, row_number() OVER (ORDER BY cost, threshold) = 1 AS selected FROM sweep""",
)
def flagship(spark, sf_dir):
    # Staged once: the split counts the rows before it places them, and should not redo the history.
    frame = staged(contacts(spark, sf_dir).select("contact_id", "y", *FULL.required_columns()), "contacts")
    valid = fail_fast(frame, [Rule("age within 18..100", out_of_range("age", 18, 100))])
    split = stratified_split(valid, "contact_id")
    validation = score(split.filter("split = 'validation'"))
    return mark_selected(threshold_table(validation))
