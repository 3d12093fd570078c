"""stopclock: transit-feed analytics as plain Spark DataFrame plans.

The package is a set of functions that take DataFrames and return DataFrames.
Nothing is executed until the caller runs an action, except in the few functions
whose docstring says so (writers, and the batch nearest-neighbour join, which
first looks at cell counts).

Every session must run in the UTC time zone: calendar days of the event tables are
UTC days.  ``stopclock.session.build_session`` sets that and the adaptive options.
"""

__version__ = "0.1.0"
