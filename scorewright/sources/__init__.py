from scorewright.sources.tables import read_table
from scorewright.sources.fixtures import (statements, events_statements, customer_truth, train_labels,
                                          test_spine, STATEMENT_NUMERIC, STATEMENT_CATEGORICAL)

__all__ = ["read_table", "statements", "events_statements", "customer_truth", "train_labels", "test_spine",
           "STATEMENT_NUMERIC", "STATEMENT_CATEGORICAL"]
