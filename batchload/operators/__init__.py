"""DataFrame to DataFrame operators: extraction, projection, audit."""
