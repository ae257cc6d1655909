"""DataFrame -> DataFrame operators: profile, filters, features, metrics, history."""
