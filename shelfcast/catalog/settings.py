"""Parameters of the registered queries."""

# The sparse panel thins out at its end, so a holdout of half a year is what most
# pairs can fill; the library default is 28 days.
VALID_DAYS = 180
RECENT_DAYS = 365
FOLDS = 3
STEP_DAYS = 180

# Size of the tree models: the defaults of Spark's own learners. The functions' defaults are
# the sizes of full training runs.
BOOSTING = {"max_iter": 20, "depth": 5}
FOREST = {"trees": 20, "depth": 5}
# Settings that the registered search draws.
SEARCH_TRIALS = 8
