"""Operators: DataFrame -> DataFrame functions (fit steps return small statistics tables).

profile   nulls, describe, medians, categories, histograms, correlation (N3-N9, A1-A21)
quantile  exact quantiles in bounded memory (A4)
numeric   imputation, rule-based standardisation, scaling (N1, N10, E1, E13, E14, F5)
category  sentinel fill, rare masking, string index, one-hot (N2, E2-E5, E7, F6, F7, F9)
select    chi-square selection (E8)
cross     assemble, crosses, pack + class weights, hashing (E6, E9-E12, S12)
split     hash splits, samples, over/under-sampling (P1-P11)
evaluate  exact rank AUC, hard-label AUC, confusion metrics (V1, V2, V5)
svm       hand-written linear SVM by sub-gradient descent (M7, E15-E17, F11)
model     Spark ML classifiers, sweeps, cross-validation, harness (M1-M6, M8-M10, V3, V4)
"""
