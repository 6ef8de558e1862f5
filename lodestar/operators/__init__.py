"""DataFrame -> DataFrame operators of the retail star."""
