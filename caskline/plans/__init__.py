"""The business questions, each a function from facts and dimensions to a lazy DataFrame.

``sales`` is always the output of ``sales_measures``; dimensions may come without surrogate keys.
Every threshold, year and date is a keyword with the usual business value as its default.

Three habits keep these plans cheap on large facts. Facts are aggregated to the grain of a dimension's
id before that dimension is joined, so a join moves one row per id. And several distinct counts in
one result are taken in steps: ``txn_id`` is counted per account and representative first, which is
exact because a transaction belongs to one account and one representative. And results are sorted
with their ids as last resort, so that rows with equal sort values do not all land in one task.
"""
