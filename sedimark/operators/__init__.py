"""DataFrame to DataFrame operators; none of them triggers a job unless its docstring says so."""
