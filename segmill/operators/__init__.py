"""DataFrame operators: feature choice, projection, sampling, preparation, clustering, description."""
