from keelson.functions.expr import (  # noqa: F401
    argmax_index,
    argmin_index,
    array_dot,
    array_sqdist,
    array_sqdist_cols,
    cols_sqdist,
    linear,
    log_loss_margin,
    max_of,
    monomial,
    monomial_exponents,
    normal_log_pdf,
    rbf,
    sigmoid,
    sigmoid_prime,
)
