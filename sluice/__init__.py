"""Lake and warehouse analytics as lazy Spark operators.

Layout:

* ``functions``  column expressions (cleaning, bands, calendar, rounding)
* ``operators``  DataFrame -> DataFrame building blocks (matching, merging, keys, ranking)
* ``sources``    readers and sinks for files, databases and the activity log
* ``plans``      the warehouse, sales, engagement, scoring, report and finding plans
* ``streaming``  the activity-stream plans, usable on batch frames as well
"""
