"""DataFrame -> DataFrame transformations; each works on a batch and, unless its docstring says otherwise, on a stream."""
