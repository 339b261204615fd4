"""Parameters, joins, storage, the model graph and the query registry."""
