"""visitline: visit-date harmonisation for longitudinal study forms, on Spark.

Forms of a study are stacked into one observation table (subject, planned
visit, form, assessment date). The operators find visits whose forms disagree
on the date and dates claimed by several visits, flag and summarise them,
repair visit numbers and dates by majority and median rules, resolve what is
left, and derive age at visit. Everything is DataFrame-to-DataFrame; no
Python UDF runs in any plan.
"""

__version__ = "0.1.0"
