"""Domain views, business models, the query catalogue, the model graph and the SQL guard."""
