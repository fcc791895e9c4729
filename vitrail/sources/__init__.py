"""Sources and sinks: delimited text, labelled points, libsvm, edge lists, models."""
