"""Column types of the warehouse, as DDL text.

Scales are part of the results and are fixed.  Precisions are set for sums over
very large tables: under ANSI mode an overflow ends the job, so the room in
front of the decimal point is wider than a small installation would need.
"""

ORDER_AMOUNT = "decimal(20,2)"  # money on an order
LINE_TOTAL = "decimal(20,4)"  # quantity x unit price
LINE_AMOUNT = "decimal(24,8)"  # line money after a percentage
AMOUNT = "decimal(28,2)"  # summed money and quantities
SMALL_AMOUNT = "decimal(10,2)"  # single small money values
AVERAGE = "decimal(20,2)"
FREQUENCY = "decimal(20,4)"
DAYS = "decimal(9,2)"
RATE = "double"  # percent, 0 to 100
EFFICIENCY = "decimal(20,10)"  # a percent held exactly enough to average
