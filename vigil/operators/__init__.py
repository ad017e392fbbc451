"""DataFrame -> DataFrame operators: ordering and windows, model, reports, serving, output."""
