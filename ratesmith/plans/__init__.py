"""Jobs as compositions of operators, derived test inputs and registered queries."""
