"""Parameters shared by the queries and their SQL counterparts."""

GRID = 8
WIDE_GRID = 12
PATH_DEPTH = 6

THRESHOLD = 2000
MAX_DEPTH = 10
MINIMUM = 3000
# A minimum far above the threshold.
LARGE_MINIMUM = 10_000
PAGE_MEMBERS = 3

# A lower threshold with the stop at more than 50 heavy cells.
CAPPED_THRESHOLD = 500
MAX_HEAVY_CELLS = 50

VECTOR_THRESHOLD = 20
VECTOR_MINIMUM = 15

EVENT_THRESHOLD = 200
EVENT_MINIMUM = 150
EVENT_DEPTH = 8

STEP_GRID_DEPTH = 2
STEP_THRESHOLD = 3000
HEAVY_DEPTH = 3
WRITTEN_ROWS = 1000

# Block size that makes the row estimate a few thousand rows per file.
SMALL_BLOCK_BYTES = 200_000
BLOCK_MINIMUM = 1500

PAGE_ROWS = 200
# Rows a cell may hold before its rows go to several files, and where cells are cut.
FILE_THRESHOLD = 10_000
ROWS_PER_FILE = 2000
LARGE_CELL = 3750
# Tasks that cells are dealt to, and rows above which a cell is written in several files.
TASKS = 7
DEALT_ROWS = 1500
# Low and high price, low and high quantity.
REGION = (20_000.0, 41_000.5, 12.0, 30.5)
WRITTEN_CELL = "_13"
CLUSTERS = 10
FIRST_ROWS = 100
# Starts of the clusters, and steps per unit in which their sums are taken.
STARTS = 3
ROUNDS = 10
SUM_SCALE = 1 << 20
