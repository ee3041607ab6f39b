"""spanfeat: features over spans of space and time, as Spark DataFrame functions."""
