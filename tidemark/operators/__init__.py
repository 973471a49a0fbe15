"""The layers' transformations, each a function from DataFrame to DataFrame."""
