"""Training-data operators (one module each) and their registered queries (``queries``)."""
