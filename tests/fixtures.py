"""Hand-made retail rows covering the edge cases of FIXTURES.md §4."""

from __future__ import annotations

from cartwise.sources import schemas as S

NaN = float("nan")

# user 1: one prior order (gap NULL), then a train order
# user 2: two prior orders, then train
# user 3: five prior orders, then train
# user 4: order numbers with a hole (1, 2, 5), then train
# user 5: two prior orders without lines, then train
# user 6: prior orders, then a 'test' order
# user 7: one prior order with lines, then train (label order has reordered = 0 line)
ORDERS = [
    # order_id, user_id, eval_set, order_number, dow, hour, days
    (101, 1, "prior", 1, 0, 10, None),
    (102, 1, "train", 2, 1, 11, 7.0),
    (201, 2, "prior", 1, 2, 8, None),
    (202, 2, "prior", 2, 3, 9, 10.0),
    (203, 2, "train", 3, 4, 9, 5.0),
    (301, 3, "prior", 1, 0, 1, None),
    (302, 3, "prior", 2, 0, 2, 1.0),
    (303, 3, "prior", 3, 0, 3, 2.0),
    (304, 3, "prior", 4, 0, 4, 3.0),
    (305, 3, "prior", 5, 0, 5, 4.0),
    (306, 3, "train", 6, 0, 6, 5.0),
    (401, 4, "prior", 1, 1, 12, None),
    (402, 4, "prior", 2, 1, 12, 3.0),
    (405, 4, "prior", 5, 1, 12, 9.0),
    (406, 4, "train", 6, 1, 12, 2.0),
    (501, 5, "prior", 1, 5, 20, None),
    (502, 5, "prior", 2, 5, 21, 30.0),
    (503, 5, "train", 3, 5, 22, 30.0),
    (601, 6, "prior", 1, 6, 7, None),
    (602, 6, "prior", 2, 6, 7, 14.0),
    (603, 6, "test", 3, 6, 7, 14.0),
    (701, 7, "prior", 1, 2, 15, None),
    (702, 7, "train", 2, 2, 15, 8.0),
]

PRIOR = [
    # order_id, product_id, add_to_cart_order, reordered
    (101, 10, 1, 0), (101, 11, 2, 0),
    (201, 10, 1, 0), (202, 10, 1, 1), (202, 12, 2, 0),
    (301, 10, 1, 0), (302, 10, 1, 1), (303, 10, 1, 1), (304, 11, 1, 0), (305, 10, 1, 1),
    (401, 12, 1, 0), (402, 12, 1, 1), (405, 12, 1, 1), (405, 99, 2, 0),   # 99: unknown product
    # user 5's prior orders have no lines
    (601, 10, 1, 0), (602, 10, 1, 1),
    (701, 13, 1, 0), (701, 14, 2, 0),
]

TRAIN = [
    (102, 10, 1, 1),            # candidate bought again -> label 1
    (203, 12, 1, 1),
    (203, 15, 2, 0),            # never bought before -> no candidate
    (306, 10, 1, 1),
    (406, 99, 1, 1),            # unknown product reordered -> label 1, features 0
    (503, 10, 1, 0),
    (702, 13, 1, 0),            # in the label basket but reordered = 0 -> label 0
]

PRODUCTS = [
    (10, "banana", 24, 4),
    (11, "apple", 24, 4),
    (12, "milk", 84, 16),
    (13, "banana", 24, 4),      # same name as product 10
    (14, "bread", 112, 3),
    (15, "eggs", 86, 16),
]


def frames(spark):
    return (spark.createDataFrame(ORDERS, S.ORDERS), spark.createDataFrame(PRIOR, S.ORDER_LINES),
            spark.createDataFrame(TRAIN, S.ORDER_LINES), spark.createDataFrame(PRODUCTS, S.PRODUCTS))
